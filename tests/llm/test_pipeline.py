"""The stages over a small table: each one's decision, and the whole run."""

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import common, language, mixing, planes, queries, shingle_join
from ledgerline.llm.common import read, save
from tests.conftest import SF_SMALL
from tests.llm.test_operators import DE, docs, linked, rows, same  # noqa: F401


def test_stages(spark, docs, tmp_path):  # noqa: F811
    spark.createDataFrame([(1, DE + " " + DE)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        kept = save(stage(spark, kept, str(tmp_path)), f"test-{name}")
        seen[name] = kept.collect()
        assert name == "token_files" or kept.columns == docs.columns
    text = [(r[0], r[1]) for r in rows()]
    reference = language.learn(docs)
    parser, below = language.Parser(reference), language.most_bits(docs, reference)
    placed = [(i, t) for i, t in text if t and any(c.isalpha() for c in t) and (parser.predict(t)[2] < below or sum(map(str.isalpha, t)) < 20)]
    assert len(placed) > 30
    same([(r.doc_id, r.text) for r in seen["language"]], placed)
    wanted = {i for (i, _, c), (_, t) in zip(linked(placed), placed) if i == c}
    assert {r.doc_id for r in seen["near_copies"]} == wanted and len(seen["near_copies"]) == len(wanted)
    assert {r.doc_id for r in seen["decontaminate"]} == {i for i in wanted if not any(i == a and t and DE in t for a, t in text)}
    assert {r.doc_id for r in seen["mix"]} == {r.doc_id for r in seen["decontaminate"]}
    assert sorted(r.doc_id for r in seen["token_files"]) == sorted(r.doc_id for r in seen["mix"])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_run(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert 0 < len({r.doc_id for r in out.collect()}) <= read(spark, SF_SMALL, "documents").count()


def test_near_copies_five_words_80_percent(spark, tmp_path):
    """A block of a fifth added (0.83), five words of 230 changed (0.80 by five words), and a copy below 0.8."""
    long, words, other = ([f"{c}{i}" for i in range(n)] for c, n in (("a", 1000), ("b", 230), ("c", 300)))
    changed = ["zzz" if i % 40 == 20 and i < 200 else w for i, w in enumerate(words)]
    table = [long, long + [f"x{i}" for i in range(200)], words, changed, other, other + [f"y{i}" for i in range(90)]]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(table)], "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_copies(spark, df, str(tmp_path)).collect()) == [0, 2, 4, 5]


def test_near_copies_of_null_and_repeated_ids(spark, tmp_path):
    """Unrelated texts stay, whether they have no id or the same one; copies go, those without an id before those with one."""
    text = [" ".join(f"{c}{i}" for i in range(30)) for c in "abcdefgh"]
    rows = [(None, text[0]), (None, text[1]), (None, text[2]), (None, text[2]), (5, text[3]), (5, text[4]), (6, text[4]), (None, text[5]), (9, text[5]), (None, ""), (None, text[6] + " more"), (None, text[6])]
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path)).collect()]
    one = [x for x in got if x[1] in (text[6], text[6] + " more")]
    assert len(one) == 1
    same([x for x in got if x not in one], [(None, text[0]), (None, text[1]), (None, text[2]), (5, text[3]), (5, text[4]), (9, text[5]), (None, "")])


def test_files_hold_the_mixture_in_its_order(spark):
    """The ids lie in the order of the turns; a document's copies lie apart, and every stretch has the sources in about their weights."""
    docs = save(spark.createDataFrame([(i, f"word{i} of a text", "rare" if i % 10 == 0 else "often") for i in range(3000)], "doc_id long, text string, source string").repartition(7), "test-mix")
    stored = save(corpus_pipeline.mix(spark, docs, ""), "test-mixed")
    ids = [r.doc_id for r in planes.token_files(stored, queries.tokenizer_path(), as_stored=True).orderBy("start").collect()]
    wanted = mixing.mixed(docs).orderBy("turn", "block_key", "doc_key").collect()
    assert ids == [r.doc_id for r in wanted]
    place = {}
    for k, i in enumerate(ids):
        place.setdefault(i, []).append(k)
    apart = [b - a for p in place.values() for a, b in zip(p, p[1:])]
    assert len(ids) > 3000 and min(apart) > 100


def test_texts_are_parsed_once(spark, docs, monkeypatch):  # noqa: F811
    """The language stage keeps the rows of ``placed`` below ``most_bits``, and parses only those again that may go."""
    reference = language.learn(docs)
    wanted = language.placed(docs, reference, language.most_bits(docs, reference)).collect()
    again = []
    monkeypatch.setattr(language, "identify", None)
    monkeypatch.setattr(language, "placed", lambda few, *how, f=language.placed: again.append(few.count()) or f(few, *how))
    got = corpus_pipeline.language_stage(spark, docs.withColumn("h", F.lit(1)), "")
    assert got.columns == [*docs.columns, "h"]
    same([(r.doc_id, r.text) for r in got.collect()], [(r.doc_id, r.text) for r in wanted])
    assert len(wanted) > 30 and again == [docs.count() - len(wanted)]
    assert corpus_pipeline.language_stage(spark, docs.withColumn("lang", F.lit(None).cast("string")), "").count() == 0


def test_workers_hold_few_rows_and_give_memory_back(monkeypatch):
    """A batch of 10,000 long texts is never a list of 10,000 strings, and a task's freed memory does not stay with its worker."""
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    batch = pa.RecordBatch.from_pydict({"text": [str(i) for i in range(1201)]})
    seen = [common.texts(x) for x in common.in_slices(iter([batch, batch.slice(0, 0)]))]
    assert [len(x) for x in seen] == [500, 500, 201] and [t for x in seen for t in x] == [str(i) for i in range(1201)]
    assert given == [1]


def test_representatives_are_known_by_their_text(spark):
    """One row of a group stays without a set being made twice; rows without words stay as they are."""
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(3, text), (3, text), (1, text.upper()), (1, text), (None, None), (None, None), (7, " \t\n\x0b\f\r"), (8, "\u00a0"), (9, "\u00a0"), (10, "é")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text) for r in shingle_join.one_of_each(df).collect()]
    same(got, [(1, text.upper()), (None, None), (None, None), (7, " \t\n\x0b\f\r"), (8, "\u00a0"), (10, "é")])
    plan = shingle_join.one_of_each(df)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan
