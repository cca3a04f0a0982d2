"""Spelling variants, the filter audit and one-permutation hashing against brute force, and their edge cases."""

import collections
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import bits, filter_audit, hot, minhash, queries, spelling
from ledgerline.llm.common import read, save, ship
from ledgerline.llm.shingles import shingles
from tests.conftest import SF_SMALL
from tests.llm.test_operators import docs, labels, linked, none, rows, same  # noqa: F401


def table(spark, texts, schema="doc_id long, text string"):
    ship(spark)
    return spark.createDataFrame(texts, schema)


# ---------------------------------------------------------------- spelling variants

def occurrences(pairs):
    """Words and counts, occurrence by occurrence."""
    n = collections.Counter()
    for doc_id, text in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 6:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= 5}


def brute_variants(pairs):
    n = occurrences(pairs)
    letters = sorted({c for w in n for c in w})
    near = {}
    for w in n:
        cuts = {w[:i] + w[i + 1 :] for i in range(len(w))}
        more = {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        other = {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters}
        near[w] = ((cuts | more | other) - {w}) & n.keys()
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def made_words():
    r = random.Random(3)
    words = ["".join(r.choice("abcé") for _ in range(r.randint(6, 9))) for _ in range(150)]
    # a chain of forms, runs of one letter, anagrams, capitals, a very long word and its slip
    chain = ["banana" * 2, "banana" * 2 + "s", "banana" * 2 + "ss", "aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "listen", "silent", "Zürich", "zürich", "ÄÖÜßäö", "x" * 5000 + "y", "x" * 5000]
    times = [200, 30, 5, 5, 40, 300, 9, 9, 8, 30, 7, 6, 40]
    text = [w for w, k in zip(chain, times) for _ in range(k)] + [w for w in words for _ in range(r.choice((5, 6, 30, 200)))]
    r.shuffle(text)
    return text


def test_variants_match_brute_force(spark):
    text = made_words()
    pairs = [(i, " ".join(text[i::40])) for i in range(40)] + [(None, "banana7banana" * 30), (None, None), (3, ""), (3, "listen " * 6), (3, "listen " * 6)]
    for limit in (spelling.BLOCK, 40, 3):  # whole length blocks, halved ones, down to one letter
        same(spelling.variants(table(spark, pairs), limit).collect(), brute_variants(pairs))


def test_slips_are_made_as_stated(spark):
    pairs = [(i, "elephant Gardener " * 5) for i in range(600)]
    wanted = occurrences(pairs)
    assert len(wanted) > 2
    assert {r.word: r.n for r in spelling.vocabulary(table(spark, pairs)).collect()} == wanted


def test_blocks_hold_every_near_pair_once(spark):
    r = random.Random(1)
    words = sorted({"".join(r.choice("ab") for _ in range(r.randint(6, 10))) for _ in range(700)})
    vocab = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    got = {x.word: x.n_near for x in spelling.neighbours(spelling.blocks(vocab, 30)).collect()}
    def near(a, b):
        return any(b == a[:i] + c + a[i + 1 :] for i in range(len(a)) for c in "ab") if len(a) == len(b) else any(y == x[:i] + c + x[i:] for x, y in [sorted((a, b), key=len)] for i in range(len(x) + 1) for c in "ab")
    n = collections.Counter(w for a, b in itertools.combinations(words, 2) if abs(len(a) - len(b)) < 2 and near(a, b) for w in (a, b))
    assert got == dict(n)


@pytest.mark.parametrize("x, y, at", [("garden", "gardens", 6), ("aaabbb", "aaaabbb", 0), ("garden", "gorden", 1), ("listen", "silent", -1), ("abcdef", "abcdef", -1), ("abcdef", "bcdefgh", -1)])
def test_one_edit(x, y, at):
    assert spelling.one_edit(x, y) == at


def test_variants_of_the_edge_table_and_of_given_documents(spark, docs, none):  # noqa: F811
    same(spelling.variants(docs).collect(), brute_variants([(r[0], r[1]) for r in rows()]))
    assert spelling.variants(none).collect() == []
    given = [(r.doc_id, r.text) for r in read(spark, SF_SMALL, "documents").collect()]
    same(queries.QUERIES["op11_spelling"](spark, SF_SMALL).collect(), brute_variants(given))


# ---------------------------------------------------------------- filter audit

def brute_audit(pairs, marks):
    """part, order, step and the counts, document by document."""
    first = {}
    for doc_id, text, _ in pairs:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    quality, toxic = collections.defaultdict(int), collections.defaultdict(int)
    for doc_id, q, t in marks:
        if doc_id is not None:
            quality[doc_id], toxic[doc_id] = max(quality[doc_id], q or 0), max(toxic[doc_id], t or 0)
    facts = []
    for doc_id, text, lang in pairs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
            "D": any(c in "#$%&*|" for c in text), "E": doc_id is not None and text in first and first[text] < doc_id,
        }
        facts.append((lang or "", fails, doc_id is not None and quality[doc_id] == 1, doc_id is not None and toxic[doc_id] == 1))
    out, shapley = [], collections.Counter()
    for part in {f[0] for f in facts}:
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [f for f in facts if f[0] == part]
            for step, c in enumerate(order, 1):
                gone = [f for f in left if f[1][c]]
                failing = [f for f in facts if f[0] == part and f[1][c]]
                left = [f for f in left if not f[1][c]]
                shapley[part, c] += len(gone)
                out.append((part, order, step, len(left), len(gone), len(failing) - len(gone), sum(sum(f[1].values()) == 1 for f in failing), sum(f[2] for f in gone), sum(f[3] for f in gone)))
    return [(*row, shapley[row[0], row[1][row[2] - 1]]) for row in out]


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audit_rows():
    long = " ".join(f"w{i}" for i in range(120))
    texts = [(1, long, "en"), (2, long, "en"), (2, long, "de"), (2, "other " * 200, "en"), (3, long, None), (3, long, ""), (None, long, "en"), (4, None, "en"), (5, "", "en"), (6, "A" * 300, "de"), (7, long + " 5%", "de"), (8, long + " 5%", "de"), (9, "xé Z# " * 90, "fr"), (10, "many " * 30_000, "fr"), (None, None, None), (2, long, "en")]
    marks = [(1, 1, 0), (2, 0, 1), (2, 1, None), (3, None, None), (7, 1, 1), (None, 1, 1), (99, 1, 1)]
    return texts, marks


def test_audit_matches_brute_force(spark):
    texts, marks = audit_rows()
    for n_bits in (filter_audit.FILTER_BITS, 15):
        got = filter_audit.audit(table(spark, texts, "doc_id long, text string, lang string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int"), n_bits)
        same(got.select(*COLUMNS).collect(), brute_audit(texts, marks))


def test_audit_sql_matches_brute_force():
    texts, marks = audit_rows()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR); CREATE TABLE labels (doc_id BIGINT, quality INTEGER, toxic INTEGER)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", texts)
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", marks)
    same(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({filter_audit.SQL})").fetchall(), brute_audit(texts, marks))


def test_audit_of_the_edge_table_and_of_given_documents(spark, docs, none, labels):  # noqa: F811
    marks = [tuple(r) for r in labels.collect()]
    same(filter_audit.audit(docs, labels).select(*COLUMNS).collect(), brute_audit([(r[0], r[1], r[2]) for r in rows()], marks))
    assert filter_audit.audit(none, labels).collect() == []
    given = [(r.doc_id, r.text, r.lang) for r in read(spark, SF_SMALL, "documents").collect()]
    marks = [(r.doc_id, r.quality, r.toxic) for r in read(spark, SF_SMALL, "labels").collect()]
    same(queries.QUERIES["op12_filter_audit"](spark, SF_SMALL).select(*COLUMNS).collect(), brute_audit(given, marks))


def test_a_hot_text_is_dealt_over_parts(spark):
    made = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("text"))
    df = save(made.select(F.col("id").alias("doc_id"), "text", F.lit("").alias("part"), F.xxhash64("text").alias("h")), "hot")
    keys = hot.hot_keys(df, ["h"]).collect()
    assert len(keys) == 1 and keys[0].parts == 67
    assert sorted(r.doc_id for r in filter_audit.earlier_copies(df, 15).collect()) == list(range(3, 3000, 3))


def test_join_unique_is_a_join(spark):
    left = save(spark.range(1000).select((F.col("id") % 7 * (F.col("id") % 2)).alias("k"), "id").unionByName(spark.createDataFrame([(None, 5000)], "k long, id long")), "left")
    right = spark.createDataFrame([(k, f"v{k}") for k in range(0, 6)], "k long, v string")
    for how in ("inner", "left"):
        same(hot.join_unique(left, right, ["k"], how).collect(), left.join(right, ["k"], how).collect())


def test_bit_table_lets_all_wanted_rows_through(spark):
    every = spark.range(5000).select("id", F.xxhash64("id").alias("h"))
    wanted = every.filter(F.col("id") % 50 == 0).select("h")
    for n in (15, 18, 26):
        got = {r.id for r in bits.may_have(every, wanted, "h", n).collect()}
        assert set(range(0, 5000, 50)) <= got
    assert len(got) < 110


# ---------------------------------------------------------------- one-permutation hashing

def grouped(pairs):
    """(doc_id, n_shingles, component_id, kept) by all pairs."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) for _, t in pairs]
    sets = [{tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set() for w in words]
    root = list(range(len(pairs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(pairs)), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
            root[find(a)] = find(b)
    least = collections.defaultdict(list)
    for k, (i, _) in enumerate(pairs):
        if i is not None:
            least[find(k)].append(i)
    ids = [min(least[find(k)], default=None) for k in range(len(pairs))]
    return [(i, len(sets[k]), ids[k], i == ids[k]) for k, (i, _) in enumerate(pairs)]


def families(seed, n_families=12, members=14):
    """Families of texts around the threshold: short and long bases with some words changed, members of members, copies."""
    r = random.Random(seed)
    out = []
    for f in range(n_families):
        base = [f"f{f}w{r.randint(0, 10_000)}" for _ in range(r.choice((1, 3, 5, 6, 9, 14, 30, 80, 300)))]
        kin = [base]
        for _ in range(members):
            w = list(r.choice(kin))
            for _ in range(r.choice((0, 1, 1, 2, 4, 9))):
                w[r.randrange(len(w))] = f"n{r.randint(0, 10_000)}"
            kin.append(w + [f"z{r.randint(0, 99)}" for _ in range(r.choice((0, 0, 1, 2)))])
        out += [" ".join(w) for w in kin]
    r.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_match_brute_force(spark, seed):
    pairs = families(seed)
    same(minhash.near_copies(table(spark, pairs).repartition(5)).collect(), grouped(pairs))


def test_leftover_buckets_in_blocks(spark, monkeypatch):
    """No star is verified first, and blocks of a few sets: all links come from the second step."""
    pairs = families(7)
    monkeypatch.setattr(minhash, "STAR_BANDS", minhash.BANDS + 1)
    monkeypatch.setattr(minhash, "BLOCK_SETS", 3)
    monkeypatch.setattr(minhash, "BLOCK_TEXTS", 2)
    same(minhash.near_copies(table(spark, pairs)).collect(), grouped(pairs))


def test_a_large_star_is_dealt_over_parts(spark, monkeypatch):
    monkeypatch.setattr(minhash, "STAR_SETS", 4)
    base = [f"w{i}" for i in range(200)]
    pairs = [(i, " ".join(base[:i] + ["x"] + base[i + 1 :])) for i in range(60)]
    same(minhash.near_copies(table(spark, pairs)).collect(), [(i, 197, 0, i == 0) for i in range(60)])


def test_near_copies_of_the_edge_table(spark, docs, none):  # noqa: F811
    same(minhash.near_copies(docs).collect(), grouped([(r[0], r[1]) for r in rows()]))
    assert minhash.near_copies(none).collect() == []
    given = [(r.doc_id, r.text) for r in read(spark, SF_SMALL, "documents").collect()]
    same(queries.QUERIES["op13_minhash"](spark, SF_SMALL).collect(), grouped(given))


def test_sketches_estimate_the_similarity():
    """Equal bins are as many as the Jaccard similarity says, for sets of a few and of many shingles; no bin stays empty."""
    r = np.random.default_rng(2)
    for n in (1, 2, 5, 20, 150, 3000):
        agree = []
        for _ in range(300):
            pool = r.integers(0, 2**64, n + max(1, n // 4), dtype=np.uint64)
            a, b = np.sort(pool[:n]), np.sort(pool[len(pool) - n :])
            union = len(pool)
            agree.append((minhash.sketch(a) == minhash.sketch(b)).mean() - (2 * n - union) / union)
        assert abs(np.mean(agree)) < 4 * max(np.std(agree), 0.01) / 300**0.5, n
    tokens = shingles("one two three four five six", 4)
    assert len(np.unique(minhash.sketch(tokens))) == len(tokens) == 3


def test_signatures_are_decimals():
    for text in ("", "a", "one two three four five"):
        assert 0 <= int.from_bytes(minhash.signature(shingles(text)), "little") < 10**38
