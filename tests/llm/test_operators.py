"""Brute-force versions, and the edge cases of every operator: nulls, empty and long texts, ties, repeated rows, empty tables,
extra columns that are named like results."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import components, disclosure, fourier, language, licenses, line_crf, mixing, planes, queries, repeats, shingle_join, spaced_seeds
from ledgerline.llm.common import read, save, ship
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, score double, key string, sig long, epoch int, spans string, group_sig long, mix_source string"
EN = "The quick brown fox jumps over the lazy dog while the old man is reading a book in the garden of his house."
DE = "Der schnelle braune Fuchs springt ueber den faulen Hund und der alte Mann liest ein Buch im Garten des Hauses."
LONG = " ".join(f"word{i % 977} filler{i % 31}." for i in range(20_000))


def rows():
    r = random.Random(5)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
    made = [" ".join(r.choice(words) + str(r.randint(0, 40)) for _ in range(r.randint(30, 120))) for _ in range(20)]
    base = " ".join(f"token{i}" for i in range(150))
    near = base.replace("token75", "other")
    passage = " ".join(f"shared{i}" for i in range(70))
    out = [EN, DE, EN, EN + " " + DE, None, "", " \n\t ", "one", "two words", "two words", LONG, base, near, base + " more", made[0] + " " + passage + " " + made[1], made[2] + " " + passage + " " + made[3], "a" * 900, "12345 678 " * 30, "x\x1cy é　漢  \n \n z"]
    out += made + [f"Write to jo{i % 2}@mail.example.org from zanzibar{i % 2} please, letter {i}" for i in range(8)] + ["Released under the MIT License. " + made[4]]
    got = [(i, t, ("de" if t == DE else "en") if t else None, None if i % 5 == 0 else f"s{i % 3}", 1, 1, 1.0, "k", 1, 1, "x", 1, "m") for i, t in enumerate(out)]
    return [*got, got[0], got[0], (None, EN, "en", "s1", 1, 1, 1.0, "k", 1, 1, "x", 1, "m"), (None, None, None, None, None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    return save(spark.createDataFrame(rows(), SCHEMA).repartition(3, F.coalesce("doc_id", F.lit(0))), "test-docs")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 4 != 0) if i % 9 else None, 0) for i in range(40)] + [(3, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")


def key(x):
    return tuple((v is None, v if v is not None else 0) for v in x)


def same(got, wanted):
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, wanted), key=key)


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_line_crf(spark, docs, none, labels):
    def base(text):
        text = text or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        grams = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        hit = {j for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
        return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), len(words) < 20 or 100 * len(hit) > 30 * len(words))

    chain = line_crf.fit(docs, labels)
    out = line_crf.judge(docs, chain, with_text=True).collect()
    same([(r.doc_id, *r[1:7]) for r in out], [(r[0], *base(r[1])) for r in rows()])
    assert not any(r.kept for r in out if r.base_failed)
    assert line_crf.judge(none, line_crf.fit(none, labels)).count() == 0
    assert all(x == 0 for x in line_crf.fit(docs, labels.limit(0)).viterbi(np.ones((4, len(line_crf.FEATURES)))))


def test_viterbi_is_the_best_path():
    import itertools

    r = np.random.default_rng(3)
    for _ in range(30):
        chain = line_crf.Chain(r.normal(size=len(line_crf.FEATURES)), r.normal(size=(2, 2)))
        x = r.normal(size=(6, len(line_crf.FEATURES)))
        unary = x @ chain.unary
        score = lambda y: sum(unary[i] * y[i] for i in range(6)) + sum(chain.pair[y[i], y[i + 1]] for i in range(5))  # noqa: E731, B023
        assert tuple(chain.viterbi(x)) == max(itertools.product((0, 1), repeat=6), key=score)


def test_planes(spark, docs, none):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    whole = Tokenizer.from_file(path)
    start, wanted = 0, []
    for r in sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array(whole.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4")
        wanted.append((r[0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    for kind in ("bit", "byte"):
        same(planes.token_files(docs, path, kind).collect(), wanted)
    assert planes.token_files(none, path).count() == 0


def test_planes_round_trip():
    r = np.random.default_rng(1)
    for n in (1, 7, 8, 1000):
        for top in (1, 2, 300, 50_000, 2**32):
            ids = r.integers(0, top, n, dtype=np.uint32)
            for kind in ("bit", "byte"):
                assert (planes.unpack(planes.pack(ids, kind), n, kind) == ids).all()


def test_encoder_cuts_where_the_library_does():
    from tokenizers import Tokenizer

    path, r = queries.tokenizer_path(), random.Random(9)
    mine, whole = planes.Encoder(path), Tokenizer.from_file(path)
    parts = [" ", " ", "\n", "a", "b'", "s", "é", "1", "!", "\xa0", "　", "漢", "\x1c", "\t", "'ll", "<|endoftext|>", "😀", "Word", ".", "\r"]
    for _ in range(4000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 14)))
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def duck(sql, docs):
    import duckdb

    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"}))
    return con.sql(sql)


def test_mixing(spark, docs, none):
    out = mixing.mixed(docs)
    sql = duck(mixing.SQL, docs)
    same(out.select(sql.columns).collect(), sql.fetchall())
    assert mixing.mixed(none).count() == 0 and mixing.mixed_rows(none).count() == 0
    back = mixing.mixed_rows(docs)
    assert back.columns == docs.columns and back.count() == out.count()
    assert back.filter("mix_source <> 'm'").count() == 0
    assert {r.doc_id for r in back.collect()} >= {r[0] for r in rows() if r[1] and WORD.search(r[1])}


def test_mixing_budget_and_entropy(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 7), "big" if i % 3 else "small") for i in range(900)], "doc_id long, text string, source string")
    rows_ = save(mixing.counted(docs), "test-counted")
    tokens = dict(rows_.groupBy("source").agg(F.sum("n_tokens")).collect())
    for entropy in (0.60, 0.65, 0.69):
        a = mixing.exponent(rows_.groupBy("mix_source").agg(F.sum("n_tokens").alias("tokens")), None, entropy)
        w = np.array(list(tokens.values()), float) ** a
        w /= w.sum()
        assert -(w * np.log(w)).sum() == pytest.approx(max(entropy, 0), abs=1e-4) or a in (0.0, 1.0)
    plan = {r.mix_source: r for r in mixing.plan(rows_, max_repeats=None, target_entropy=0.69, budget=1500, block_docs=50).collect()}
    shown = dict(mixing.mixed(docs, max_repeats=None, target_entropy=0.69, budget=1500, block_docs=50).groupBy("source").agg(F.sum("n_tokens")).collect())
    for source, n in shown.items():
        assert plan[source].quota - 7 < n <= plan[source].quota


def test_spaced_seeds(spark, docs, none):
    item = "every single one of these thirty words was written down so that a test could find them again in some other place even when a few have been changed"
    words = item.split()
    swapped = " ".join("zzz" if i % 6 == 5 else w for i, w in enumerate(words))
    texts = [EN + " " + item + " " + DE, "before " + swapped.upper() + " after", EN, " ".join(words[:8]), None, "", " ".join("zzz" if i % 2 else w for i, w in enumerate(words)), item, item]
    table = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(7, item), (7, item), (8, "too short"), (9, None), (None, "")], "item_id long, text string")
    found = spaced_seeds.contaminated(table, items).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(d, 7) for d in (0, 1, 7, 8) for _ in range(2)]
    assert {r.doc_id: r.n_equal for r in found} == {0: 30, 1: 25, 7: 30, 8: 30} or all(r.n_equal >= 24 for r in found)
    blocks = spaced_seeds.contaminated(table, items, block_words=1).collect()
    same(found, blocks)
    assert [r.doc_id for r in spaced_seeds.uncontaminated(table, items).orderBy("doc_id").collect()] == [2, 3, 4, 5, 6]
    assert spaced_seeds.contaminated(none, items).count() == 0 and spaced_seeds.contaminated(docs, items.limit(0)).count() == 0
    assert spaced_seeds.uncontaminated(docs, items.limit(0)).count() == len(rows())


def test_spaced_seeds_find_all_patterns():
    """Every placement of up to a fifth of substitutions in a short item, by brute force."""
    for n in (8, 9, 10, 11, 13, 15, 16, 20):
        words = [f"w{i}" for i in range(n)]
        items = spaced_seeds.Items([(1, " ".join(words))])
        for k in range(n // 5 + 1):
            if n - k >= 0.8 * n:
                for at in itertools.combinations(range(n), k):
                    text = "before it " + " ".join("zzz" if i in at else w for i, w in enumerate(words)) + " after"
                    assert [x[4] for x in items.overlaps(text, 13, 0.8, 0.8)] == [n - k], (n, at)


def test_masks_miss_no_stretch():
    """The least substitutions that keep all masks from hitting, for each length: always more than a fifth."""
    bits, least = [(len(m), int(m, 2)) for m in spaced_seeds.MASKS], {0: 0}
    for n in range(1, 300):
        new = {}
        for state, k in least.items():
            for equal in (0, 1):
                now = (state << 1 | equal) & 255
                if not (equal and any(n >= size and now & m == m for size, m in bits)):
                    new[now] = min(new.get(now, n), k + 1 - equal)
        least = new
        assert n < 8 or 5 * min(least.values()) > n


def test_best_stretch():
    r = np.random.default_rng(4)
    for _ in range(2000):
        equal = r.random(int(r.integers(1, 40))) < r.choice([0.3, 0.75, 0.9])
        n = max(int(equal[a:b].sum()) for a in range(len(equal)) for b in range(a, len(equal) + 1) if 5 * equal[a:b].sum() >= 4 * (b - a))
        a, b = spaced_seeds.best_stretch(equal)
        assert equal[a:b].sum() == n and 5 * n >= 4 * (b - a)


def removed(texts):
    raws = [(t or "").encode() for t in texts]
    n = collections.Counter(b[i : i + 400] for b in raws for i in range(len(b) - 399))
    for b in raws:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 399):
            if n[b[i : i + 400]] > 1:
                gone[i : i + 400] = True
        left = bytes(c for c, g in zip(b, gone) if not g)
        yield len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(left).hexdigest()


@pytest.mark.parametrize("group", [repeats.GROUP, 1])
def test_repeats(spark, docs, none, group):
    r = random.Random(11)
    letters = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    p, q = letters(700), letters(1500)
    texts = [letters(300) + p + letters(200), letters(10) + p[100:560] + letters(900), p[:399], p[:400], q, q[:600] + "X" + q[601:], q[5:1200], q, None, "", "ab" * 700, "é" * 500, letters(200) + q[700:1099], letters(50) + p[:500] + letters(3) + p[200:]]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, key string").withColumnRenamed("key", "text").withColumn("key", F.lit("clash"))
    out = {x.doc_id: tuple(x)[1:] for x in repeats.without_repeats(table, group).collect()}
    assert out == dict(enumerate(removed(texts)))
    if group > 1:
        same([tuple(x)[1:] for x in repeats.without_repeats(docs, group, with_text=True).drop("kept").collect()], removed([r[1] for r in rows()]))
        assert repeats.without_repeats(none).count() == 0


def test_repeats_tree():
    """The interval tree's maximal repeats are all pairs' common strings."""
    r = random.Random(2)
    lefts = ["".join(r.choice("ab") for _ in range(6)).encode() for _ in range(12)]
    rights = ["".join(r.choice("ab") for _ in range(6)).encode() for _ in range(12)]
    same_start = lambda a, b: next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
    got = collections.defaultdict(set)
    for size, members, ls in repeats.maximal_repeats(lefts, rights, 8):
        for m, x in zip(members, ls):
            got[m] |= {(u, v) for u in range(x + 1) for v in range(size + 1) if u + v >= 8}
    for i in range(12):
        wanted = {(u, v) for j in range(12) if j != i for u in range(same_start(lefts[i], lefts[j]) + 1) for v in range(same_start(rights[i], rights[j]) + 1) if u + v >= 8}
        assert got[i] == wanted


def test_fourier(spark, docs, none, labels):
    stats = save(fourier.measured(docs), "test-stats")
    out = fourier.scored(stats, fourier.fit(stats, labels)).collect()
    assert len(out) == len(rows()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert {r.score for r in fourier.scored(stats, fourier.fit(stats, labels.limit(0))).collect()} == {0.5}
    assert fourier.scored(fourier.measured(none), fourier.fit(stats, labels)).count() == 0
    assert fourier.isotonic(np.array([3.0, 1, 2, 5]), np.array([1.0, 1, 1, 1])).tolist() == [2, 2, 2, 5]


def test_fourier_held_out(spark):
    stats = save(fourier.measured(read(spark, SF_SMALL, "documents")), "test-stats")
    labels = read(spark, SF_SMALL, "labels")
    got = fourier.scored(stats, fourier.fit(stats, labels)).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.9


def test_language(spark, docs, none):
    r = language.learn(docs)
    assert set(r.languages) == {"en", "de"}
    out = language.identify(docs, r, "doc_id", "text").collect()
    assert len(out) == len(rows())
    for x in out:
        letters = any(c.isalpha() for c in x.text or "")
        assert (x.lang_pred == "und") == (not letters) and 0 <= x.score <= 1
        assert x.text not in (EN, DE) or x.lang_pred == ("en" if x.text == EN else "de")
    assert {x.lang_pred for x in language.identify(docs, language.learn(none)).collect()} == {"und"}
    assert language.identify(none, r).count() == 0
    assert language.placed(docs, r).columns == docs.columns


def test_cross_parse_is_the_greedy_one():
    r = random.Random(4)
    for _ in range(60):
        text, query = ("".join(r.choice("abc") for _ in range(n)) for n in (25, 30))
        query += r.choice(["", "d", "dd"])
        n, i = 0, 0
        while i < len(query):
            j = i
            while j < len(query) and query[i : j + 1] in text:
                j += 1
            i, n = max(j, i + 1), n + 1
        assert language.phrases(language.suffix_automaton(text), query) == n


def test_language_held_out(spark):
    docs = read(spark, SF_SMALL, "documents")
    got = language.identify(docs, language.learn(docs), "doc_id", "lang").collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.95


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def personal(text):
    def luhn(d):
        return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))) % 10 == 0

    out = []
    for n, (kind, p) in enumerate(PII.items()):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                out.append((m.start(), n, m.end(), kind))
    return sorted(out)


def test_disclosure(spark, docs, none):
    r = random.Random(2)
    parts = ["a", "b.c", "@", "@x", ".", "1", "23", "4.5", "255.", "256.1.2.3", "1.2.3.4", " ", "-", "+", "+1", "(017)", "4111111111111111", "é", "_", "%", "\n", "4111 1111 1111 1111", "555-7713", "12.12.12.12.12", "0000000000000", "😀"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 25))) for _ in range(1500)] + [None, "", "1." * 3000 + "1" * 3000 + " 2" * 2000 + "a" * 3000]
    table = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    for x in disclosure.private(table).collect():
        base = personal(texts[x.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for a, _, b, k in base)
        assert (x.n_email, x.n_ip, x.n_card, x.n_phone) == tuple(sum(s[3] == k for s in base) for k in PII)
        assert x.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert {*filter(None, listed.split(","))} <= {*filter(None, x.spans.split(","))}
    assert disclosure.private(none).count() == 0


def test_disclosing_terms(spark, docs):
    """zanzibar0 stands beside jo0 only, in four different texts; 'please' beside both; counted by hand."""
    out = {r.doc_id: r for r in disclosure.private(docs).filter("n_email > 0").collect()}
    text = {r[0]: r[1] for r in rows()}
    for i, r in out.items():
        terms = [text[i][int(a) : int(b)] for kind, a, b in (x.split(":") for x in r.spans.split(",")) if kind == "term"]
        assert f"zanzibar{text[i].count('jo1@')}" in terms and "from" not in terms and r.n_removed >= 1
    clean = {r.doc_id: r.text for r in disclosure.sanitised(docs).collect() if r.doc_id in out}
    assert all("@" not in t and "zanzibar" not in t and "[email]" in t for t in clean.values())


def test_disclosing_terms_anywhere(spark):
    """Two documents name a value, far from the word that goes with it; a third holds the word alone. Words of one document, or common ones, stay."""
    r = random.Random(12)
    common = [f"common{i}" for i in range(400)]
    fill = lambda n: " ".join(r.choices(common, k=n))
    texts = [fill(20) + f" once{i}" for i in range(4000)]
    texts[7] = f"Zanzibar {fill(300)} once7 4@mail.example.org {fill(5)}"
    texts[8] = f"{fill(5)} 4@MAIL.example.org {fill(60)} once8 ZANZIBAR. zanzibar"
    texts[9] = f"{fill(3)} zanzibar {fill(3)}"
    for i in range(10, 40):
        texts[i] = f"{fill(20)} {i}@mail.example.org {fill(20)} once{i}"
    out = {x.doc_id: x for x in disclosure.private(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, text in enumerate(texts):
        terms = [text[int(a) : int(b)].lower() for kind, a, b in (x.split(":") for x in filter(None, out[i].spans.split(","))) if kind == "term"]
        assert terms == ["zanzibar"] * {7: 1, 8: 2, 9: 1}.get(i, 0)


def linked(table):
    sets = []
    for _, text in table:
        w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode().split()
        sets.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) > 3 else {tuple(w)} if w else set())
    group = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) > 0 and group[a] != group[b]:
                x, y = group[a], group[b]
                group = [y if g == x else g for g in group]
    return [(i, len(s), min((table[k][0] for k in range(len(sets)) if group[k] == group[n] and table[k][0] is not None), default=None) if s else i) for n, ((i, _), s) in enumerate(zip(table, sets))]


def test_shingle_join(spark, docs, none):
    same(shingle_join.grouped(docs).drop("sig").collect(), linked([(r[0], r[1]) for r in rows()]))
    assert shingle_join.grouped(none).count() == 0


def test_shingle_join_chains(spark, monkeypatch):
    """Copies with edits at several rates; small blocks, so that clusters are verified block by block."""
    r = random.Random(6)
    table = []
    for base in range(12):
        words = [f"b{base}w{i}" for i in range(r.choice([5, 12, 30, 90]))]
        for _ in range(25):
            copy = [w if r.random() > 0.015 else f"x{r.randint(0, 5)}" for w in words]
            table.append((len(table), " ".join(copy)))
    monkeypatch.setattr(shingle_join, "BLOCK_SETS", 10)
    df = spark.createDataFrame(table, "doc_id long, text string").repartition(4)
    same(shingle_join.grouped(df).drop("sig").collect(), linked(table))


def test_keys_meet():
    """Any two sets above the similarity share a key, whatever is frequent."""
    r = np.random.default_rng(8)
    levels = np.where(r.random(1 << 10) < 0.6, 130, r.integers(0, 20, 1 << 10)).astype(np.uint8)
    for _ in range(600):
        n = int(r.integers(2, 160))
        both = r.integers(0, 2**63, n, dtype=np.uint64)
        cut = int(r.integers(0, max(1, n // 12) + 1))
        a = np.unique(np.r_[both, r.integers(0, 2**63, int(r.integers(0, max(1, n // 12) + 1)), dtype=np.uint64)])
        b = np.unique(both[cut:])
        common = len(np.intersect1d(a, b))
        if 100 * common >= 85 * (len(a) + len(b) - common):
            assert len(np.intersect1d(shingle_join.keys(a, levels), shingle_join.keys(b, levels)))


def test_components(spark):
    r, n = random.Random(3), 300
    edges = [(r.randint(-50, n), r.randint(-50, n)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)]
    group = {x: x for e in edges if e[0] != e[1] for x in e}
    for a, b in edges:
        if a != b and group[a] != group[b]:
            x, y = sorted((group[a], group[b]))
            group = {k: x if v == y else v for k, v in group.items()}
    same(components.components(spark.createDataFrame(edges, "a long, b long")).collect(), group.items())


def test_licenses(spark, docs, none):
    templates = licenses.template_table(spark)
    sql = duck(licenses.SQL, docs)
    same(licenses.scan(docs, templates).select(sql.columns).collect(), sql.fetchall())
    assert licenses.scan(none, templates).count() == 0 and licenses.scan(docs, templates.limit(0)).count() == 0
    odd = spark.createDataFrame([("short", "MIT License"), ("empty", ""), ("null", None)], "license_id string, text string")
    assert [r.license_id for r in licenses.scan(docs, odd).collect()] == ["short"]


def test_license_notices(spark):
    """Variants, headers and clauses are found; another version or license is not taken for it."""
    gpl = "under the terms of the GNU General Public License as published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version."
    cases = [
        ("Licensed under CC BY 4.0", {"CC-BY-4.0"}), ("Licensed under CC BY-NC 4.0.", {"CC-BY-NC-4.0"}), ("Licensed under CC BY-SA 3.0.", set()),
        ("Licensed under the GNU General Public License, version 3", {"GPL-3.0"}), ("This work is licensed under the GNU General Public License, version 3.", {"GPL-3.0"}),
        ("This work is licensed under the GNU General Public License, version 2.", {"GPL-2.0"}), ("the GNU Lesser General Public License, version 3", {"LGPL-3.0"}),
        (gpl.format(";", 2), {"GPL-2.0"}), (gpl.format(",", 3), {"GPL-3.0"}), (gpl.format(",", 3).replace("GNU", "GNU Affero"), {"AGPL-3.0"}), (gpl.format(";", "2.1").replace("GNU", "GNU Lesser"), {"LGPL-2.1"}),
        ("This work is licensed under a Creative Commons Attribution 4.0 International License.", {"CC-BY-4.0"}),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\")", {"MIT"}),
        ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:", {"BSD"}),
        ("This Source Code Form is subject to the terms of the Mozilla Public\n  License, v. 2.0. If a copy", {"MPL-2.0"}), ("CC0 1.0 Universal (CC0 1.0) Public Domain Dedication. Creative Commons Legal Code\n\nCC0 1.0 Universal", {"CC0-1.0"}),
        ("Licensed under the Apache License, Version 2.0 (the License)", {"Apache-2.0"}), ("Licensed under the Apache License, Version 1.1", set()), ("the license of a driver", set()),
    ]
    table = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    found = {(r.doc_id, r.license_id.split(" ")[0]) for r in licenses.scan(table, licenses.template_table(spark)).collect()}
    assert found == {(i, x) for i, (_, names) in enumerate(cases) for x in names}
    assert len({x for x, _ in licenses.TEMPLATES}) == len(licenses.TEMPLATES)


def test_registered(spark):
    import __spark_entry__ as entry

    names = [f"op{n}_" for n in range(1, 14)]
    assert all(sum(q.startswith(n) for q in entry.queries()) == 1 for n in names) and "pipeline" in entry.queries()
    assert set(queries.SQL) <= set(queries.QUERIES)


def test_license_words_are_cut_once(spark, tmp_path):
    """The texts are cut once in each of the two passes, outside all lambdas, so that time grows with a text's length only."""
    import time

    plans = []
    held = licenses.save
    try:
        licenses.save = lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or held(df, name)
        table = spark.createDataFrame([(1, "word " * 20_000 + "Licensed under the MIT License. " + "word " * 180_000), (2, "All Rights Reserved"), (3, "spdx-license-identifier:mit x")], "doc_id long, text string")
        start = time.time()
        got = licenses.scan(table, licenses.template_table(spark)).collect()
        assert time.time() - start < 60
    finally:
        licenses.save = held
    assert {(r.doc_id, r.license_id) for r in got} == {(1, "MIT licensed"), (2, "reserved rights"), (3, "MIT tag")}
    assert plans[0].count("regexp_extract_all") == 1 and not any("regexp_extract_all" in p for p in plans[1:])


def test_bitmaps_rule_out_no_link():
    """Whatever the sizes: pairs at the similarity or above pass, pairs far below mostly don't."""
    r = np.random.default_rng(4)
    passed = [0, 0]
    for _ in range(400):
        n = int(r.choice([1, 3, 15, 16, 17, 60, 64, 65, 500, 1100, 5000]))
        both = r.integers(0, 2**63, n, dtype=np.uint64)
        far = r.random() < 0.3
        cut, more = (n // 2, n // 2) if far else (int(r.integers(0, n // 10 + 1)), int(r.integers(0, n // 10 + 1)))
        a, b = np.unique(both), np.unique(np.r_[both[cut:], r.integers(0, 2**63, more, dtype=np.uint64)])
        if not len(b):
            continue
        found = list(shingle_join.open_pairs([shingle_join.bitmap(a), shingle_join.bitmap(b)], ["x", "y"], [0, 0], 0, 0, 85))
        assert bool(found) == shingle_join.may_link(shingle_join.bitmap(a), shingle_join.bitmap(b), 85) == shingle_join.may_link(shingle_join.bitmap(b), shingle_join.bitmap(a), 85)
        common = len(np.intersect1d(a, b))
        if 100 * common >= 85 * (len(a) + len(b) - common):
            assert found in ([(0, 1)], [(1, 0)])
        elif far and n > 60:
            passed[bool(found)] += 1
    assert passed[0] > 10 * passed[1]
    sets = [shingle_join.bitmap(np.arange(k, k + 40, dtype=np.uint64)) for k in range(4)]
    pairs = {tuple(sorted(p)) for p in shingle_join.open_pairs(sets, list("aabc"), [0, 1, 0, 1], 0, 1, 50)}
    assert pairs == {(0, 3), (1, 2), (2, 3)}


def test_letters_are_those_of_isalpha():
    every = [chr(c) for c in range(0x110000)]
    assert [c for c in every if language.letter_runs(c)] == [c for c in every if c.isalpha()]


def test_numerals_alone_have_no_language(spark, docs):
    r = language.learn(docs)
    table = spark.createDataFrame([(1, "\u00b2 \u00bd \u2154 12"), (2, "the house\u00b2")], "doc_id long, text string")
    assert {x.doc_id: x.lang_pred for x in language.identify(table, r).collect()} == {1: "und", 2: "en"}


def test_every_label_is_learned(spark):
    texts = [(i, f"{'abcdefghij'[i % 10] * 3}{'klmnopqrst'[i // 10 % 10] * 3}{'uvwxyz'[i // 100]} " * 4, f"l{i:03d}") for i in range(300) for _ in range(1)]
    df = spark.createDataFrame([(k * 1000 + i, t, lang) for i, t, lang in texts for k in range(3)], "doc_id long, text string, lang string")
    r = language.learn(df, sample_docs=3, sample_words=10, full_samples=100)
    seen = {x.lang for x in df.collect() if zlib.crc32(str(x.doc_id).encode()) % 3 != 1}
    assert set(r.languages) == seen and len(seen) > 280
    with pytest.raises(ValueError, match="languages"):
        language.learn(df, max_languages=100)


def test_foreign_texts_have_no_place(spark, docs):
    r = language.learn(docs)
    below = language.most_bits(docs, r)
    foreign = ["\u043f\u0440\u0438\u0432\u0435\u0442 \u043c\u0438\u0440 " * 9, "\u6f22\u5b57\u4eee\u540d\u4ea4\u3058\u308a\u6587 " * 9]
    table = spark.createDataFrame([(k, t) for k, t in enumerate([EN, DE, "ok", *foreign, "\u6f22"])], "doc_id long, text string")
    assert sorted(x.doc_id for x in language.placed(table, r, below).collect()) == [0, 1, 2, 5]
    assert language.placed(table, r).count() == 6
    labelled = [x for x in docs.collect() if x.lang and x.text and any(c.isalpha() for c in x.text) and x.doc_id is not None and zlib.crc32(str(x.doc_id).encode()) % 3 != 1]
    kept = {x.doc_id for x in language.placed(docs, r, below).collect()}
    assert {x.doc_id for x in labelled} <= kept


def test_threshold_and_words_of_all_labelled_texts(spark):
    """The last of 400 labelled texts by the hash of the id is an odd one: its words are learned, and the threshold lies above it."""
    from pyspark.sql import functions as F

    known = spark.range(400).withColumnRenamed("id", "doc_id").filter(~language.held_out(F.col("doc_id")))
    last = known.orderBy(F.xxhash64("doc_id").desc()).first().doc_id
    odd = "qxz jvq kwx zqj xvk wjq vzx qkj"
    text = F.when(F.col("doc_id") == last, odd).otherwise("the house by the river is old and the garden is wide")
    table = known.select("doc_id", text.alias("text"), F.lit("en").alias("lang"))
    assert table.count() > 250
    assert " qxz " in language.learn(table).texts[0]
    few = language.learn(table, sample_docs=200)
    assert " qxz " not in few.texts[0]
    bits = {r.doc_id: r.bits for r in language.identify(table, few).collect()}
    assert bits[last] == max(bits.values()) > min(bits.values())
    below = language.most_bits(table, few)
    assert below > bits[last] or below == float("inf")
    assert last in {r.doc_id for r in language.placed(table, few, below).collect()}


def test_one_kept_table_a_worker(spark, docs):
    """After the encoder has worked, the parser's tasks in the same worker let go of its tables."""
    from ledgerline.llm import common

    common.kept_alone("a", lambda: [1])
    assert common.kept_alone("a", lambda: [2]) == [1] and common.kept_alone("b", lambda: [3]) == [3] and list(common._KEPT) == ["b"]
    path, r = queries.tokenizer_path(), language.learn(docs)
    one = docs.coalesce(1)

    def kept(parts):
        import pyarrow as pa

        list(parts)
        yield pa.RecordBatch.from_pydict({"kept": [str(k if isinstance(k, str) else k[0].__name__ if isinstance(k, tuple) else type(k).__name__) for k in common._KEPT] or ["none"]})

    planes.token_files(one, path, "byte").count()
    language.identify(one, r).count()
    seen = {x.kept for x in spark.range(8).repartition(8).mapInArrow(kept, "kept string").collect()}
    assert "Reference" in seen or "none" in seen


def test_copies_disclose_nothing(spark):
    """Copying a corpus changes no term, and a text and its copy don't make each other's words evidence."""
    r = random.Random(21)
    common = [f"common{i}" for i in range(300)]
    fill = lambda n: " ".join(r.choices(common, k=n))
    texts = [fill(15) + f" once{i}" for i in range(1500)]
    texts[3] = texts[4] = f"{fill(40)} rare5 4@mail.example.org rare6 {fill(9)}"
    for i in (20, 21, 22):
        texts[i] = f"{fill(12)} Quagga {fill(5)} 9@mail.example.org {i}x"
    texts[30] = f"QUAGGA alone, quagga{'s'}"
    one = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    two = spark.createDataFrame([(i + k * len(texts), t) for k in range(2) for i, t in enumerate(texts)], "doc_id long, text string")
    first = {x.doc_id: x.spans for x in disclosure.private(one).collect()}
    for x in disclosure.private(two).collect():
        assert x.spans == first[x.doc_id % len(texts)]
    assert "term" not in first[3] + first[4]
    assert first[30] == "term:0:6" and all(first[i].count("term") == 1 for i in (20, 21, 22))


def test_fourier_matches_one_piece(spark):
    """The sums over partitions give the ridge solution and the isotonic fit of all rows at once."""
    r = np.random.default_rng(6)
    n, k = 400, len(fourier.STATISTICS)
    x = r.normal(size=(n, k)) * r.uniform(0.1, 5, k) + r.normal(size=k)
    y = (x[:, 0] + r.normal(size=n) > 0).astype(int)
    stats = spark.createDataFrame([(i, x[i].tolist()) for i in range(n)], "doc_id long, x array<double>").repartition(7)
    labels = spark.createDataFrame([(i, int(y[i]), 0) for i in range(n)], "doc_id long, quality int, toxic int")
    model = fourier.fit(stats, labels)
    known = np.array([zlib.crc32(str(i).encode()) % 3 != 1 for i in range(n)])
    a, b = x[known], y[known]
    mean, scale = a.mean(0), a.std(0)
    assert np.allclose(model.mean, mean) and np.allclose(model.scale, scale)
    z = fourier.cosines((a - mean) / scale)
    d = z.shape[1]
    penalty = fourier.RIDGE * len(a) * np.diag(np.r_[np.ones(d - 1) / (d - 1), 1e-9])
    weights = np.linalg.solve(z.T @ z + penalty, z.T @ b)
    assert np.allclose(z @ model.weights, z @ weights, atol=1e-6)
    assert not np.allclose(z @ weights, z @ np.linalg.lstsq(z, b, rcond=None)[0], atol=1e-3)  # the penalty shows
    # calibration: of all rising sequences over the bins the one nearest to the labels, by minimax over intervals
    bin_of = np.clip(((z @ model.weights - fourier.LOWEST) / fourier.STEP).astype(int), 0, fourier.BINS - 1)
    bins = np.unique(bin_of)
    w = np.array([(bin_of == v).sum() for v in bins])
    good = np.array([b[bin_of == v].sum() for v in bins])
    level = [max(min(good[i : j + 1].sum() / w[i : j + 1].sum() for j in range(m, len(bins))) for i in range(m + 1)) for m in range(len(bins))]
    assert np.allclose(fourier.isotonic(good / w, w), level)
    score = model.score(a)
    assert (np.diff(score[np.argsort(z @ model.weights)]) >= -1e-9).all() and score.min() >= 0 and score.max() <= 1
    got = {q.doc_id: q.score for q in fourier.scored(stats, model).collect()}
    assert np.allclose([got[i] for i in range(n)], model.score(x))


def test_only_copies_move_for_the_corpus_count(spark, monkeypatch):
    """Each distinct text counts once, and terms are counted where the texts lie: no row a text and term is shuffled, whether terms are broadcast or not."""
    r = random.Random(5)
    texts = [f"{' '.join(r.choices([f'common{i}' for i in range(200)], k=12))} once{i}" for i in range(900)] + [None, "", ""]
    for i in (5, 6, 7):
        texts[i] = f"Okapi {r.randint(0, 9)} {i} 7@mail.example.org"
    texts += texts[:40] + [texts[5]] * 30
    table = spark.createDataFrame(list(enumerate(texts)) + [(None, texts[6]), (3, texts[3])], "doc_id long, text string").repartition(5)
    of_hash = table.groupBy(disclosure._text_hash()).count().withColumnRenamed("count", "n_rows")
    assert sorted(x.text for x in disclosure.distinct_texts(table, of_hash).collect()) == sorted({t or "" for t in texts})
    few = sorted((str(x.doc_id), x.spans) for x in disclosure.private(table).collect())
    assert sum("term:0:5" in spans for _, spans in few) == 2 * 3 + 30 + 1
    for most in (disclosure.BROADCAST_TERMS, 0):
        monkeypatch.setattr(disclosure, "BROADCAST_TERMS", most)
        assert sorted((str(x.doc_id), x.spans) for x in disclosure.private(table).collect()) == few
        plan = disclosure.disclosing(table, disclosure.found(table))._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(term#" in plan and not re.search(r"hashpartitioning\((term#\w+, h#|h#\w+, term#)", plan)
