"""Audit of five document filters and of their interaction in all orders.

A to D look at a document by itself. E asks for an earlier equal text: a left-semi join on a hash of the text, the exact text and a
smaller id marks its failures; their ids are put together with the other filters' failures into one combination of bits a document, and
the documents are counted by part, combination and labels. Everything else is computed from these counts (at most 32 combinations a
part): each of the 120 orders walks through them, so the corpus is read for the combinations only.

The join of E: only texts whose hash occurs twice (a bit table of fixed size, 2^``FILTER_BITS`` bits, lets through few others) are moved; its right side is
the smallest id of each distinct text, so a group of copies is one row there; on its left side the rows of a hash with more
than one row in ``hot.SHARE`` are dealt over several keys, the number of which depends on the share only.

Defined results: a null text counts as empty; empty texts are copies of each other. A null language and an empty one are the part ``''``. A document with a null
id has no smaller id, so it never fails E, nor is it a reason to; nor do rows of the same id and text make each other fail. Repeated rows count each. Of
several labels of an id the best quality and the worst toxicity count; a null id has none. An empty table has no parts and gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import save
from ledgerline.llm.hot import hot_keys

LETTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 100, 80, 10
FILTER_BITS = 26
_PAGE = 32_768  # bits of one row of Spark's bitmaps


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def own_bits(text: Column) -> Column:
    """A to D as bits 0 to 3."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def of_words(w: Column) -> Column:
        n = F.size(w)
        return F.when(n < MIN_WORDS, 1).otherwise(0) + F.when(100 * F.size(F.array_distinct(w)) < DISTINCT_PERCENT * n, 2).otherwise(0)

    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    rest = F.when(100 * capitals > CAPITAL_PERCENT * F.length(text), 4).otherwise(0) + F.when(text.rlike(r"[#$%&*|]"), 8).otherwise(0)
    return (_bind(words, of_words) + rest).cast("int")


def _bit_pages(hashes: DataFrame, bits: int) -> DataFrame:
    """page and bitmap: a bit table of 2^bits bits, at most 2^bits / 32768 rows of 4 KB, that has all of the column ``h``."""
    at = F.pmod("h", F.lit(1 << bits))
    return hashes.groupBy(F.floor(at / _PAGE).alias("page")).agg(F.bitmap_construct_agg((at % _PAGE).cast("int")).alias("bitmap"))


def _has_bit(bits: int) -> Column:
    at = F.pmod("h", F.lit(1 << bits)) % _PAGE
    byte = F.conv(F.hex(F.substring("bitmap", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (at % 8).cast("int")) == 1


def earlier_copies(docs: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """doc_id, h and part of every row whose text also has a row with a smaller id. docs: doc_id, part, text and h (a hash of the text)."""
    named = docs.filter(F.col("doc_id").isNotNull())
    hashes = save(named.select("h"), "text-hashes")
    twice = hashes.groupBy("h").count().filter(F.col("count") > 1).select("h")
    # the rows of the few hashes with many rows are dealt over several parts
    parts = save(hot_keys(hashes, ["h"]), "hot-hashes")
    pages = F.broadcast(save(_bit_pages(twice, bits), "hash-bits"))
    page = F.floor(F.pmod("h", F.lit(1 << bits)) / _PAGE)
    moved = named.withColumn("page", page).join(pages, "page").filter(_has_bit(bits)).join(F.broadcast(parts), "h", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    left = moved.select("doc_id", "h", "part", "text", F.pmod(F.xxhash64("doc_id"), F.col("parts")).alias("own"))
    first = moved.groupBy("h", "text", "parts").agg(F.min("doc_id").alias("first"))
    right = first.select(F.col("h").alias("h2"), F.col("text").alias("text2"), "first", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("own2"))
    same = (F.col("h") == F.col("h2")) & (F.col("own") == F.col("own2")) & (F.col("text") == F.col("text2")) & (F.col("first") < F.col("doc_id"))
    return left.join(right, same, "left_semi").select("doc_id", "h", "part")


def combinations(docs: DataFrame, labels: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """part, fails (A to E as bits 0 to 4) and the counts n, good and toxic of its documents."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"), F.xxhash64(text).alias("h"))
    own = rows.select("doc_id", "h", "part", own_bits(F.col("text")).alias("fails"), F.lit(1).alias("n"))
    copies = earlier_copies(rows, bits).select("doc_id", "h", "part", F.lit(16).alias("fails"), F.lit(0).alias("n"))
    # rows of one id, text and part fail alike, so they are one group; a null id's rows are one for each text and part
    each = own.unionByName(copies).groupBy("doc_id", "h", "part").agg(F.bit_or("fails").alias("fails"), F.sum("n").alias("n"))
    known = labels.groupBy("doc_id").agg(F.max(F.col("quality").cast("int")).alias("quality"), F.max(F.col("toxic").cast("int")).alias("toxic"))
    counted = each.join(known, "doc_id", "left").groupBy("part", "fails")
    return counted.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("quality") == 1, F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """One row per part, filter_order and step, zeros included; see the columns of the contract."""
    found = save(combinations(docs, labels, bits), "combinations")
    # the bit of each step's filter and the bits of those before it, for every order
    places = [(o, k + 1, 1 << LETTERS.index(c), sum(1 << LETTERS.index(x) for x in o[:k])) for o in map("".join, permutations(LETTERS)) for k, c in enumerate(o)]
    walk = F.array(*(F.struct(F.lit(o).alias("filter_order"), F.lit(k).alias("step"), F.lit(own).alias("own"), F.lit(before).alias("before")) for o, k, own, before in places))
    at = found.select("part", "fails", "n", "good", "toxic", F.explode(walk).alias("at")).select("*", "at.*")
    fails, passed = F.col("fails").bitwiseAND(F.col("own")) != 0, F.col("fails").bitwiseAND(F.col("before")) == 0

    def total(condition: Column, of: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(of)).otherwise(0)).cast("long")

    steps = at.groupBy("part", "filter_order", "step", "own").agg(
        total(passed & ~fails).alias("kept"),
        total(passed & fails).alias("removed"),
        total(~passed & fails).alias("redundant"),
        total(F.col("fails") == F.col("own")).alias("unique_fails"),
        total(passed & fails, "good").alias("good_lost"),
        total(passed & fails, "toxic").alias("toxic_lost"),
    )
    # 600 rows a part: what a filter removes, over all orders
    return steps.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "own"))).drop("own")


#: The audit in DuckDB SQL: E asks for an earlier equal text row by row, each order walks over all documents' bits.
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
m AS (SELECT text, min(doc_id) AS first FROM d GROUP BY text),
l AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
w AS (SELECT r, doc_id, part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
b AS (SELECT w.part, coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic,
  map {{'A': len(words) < {MIN_WORDS}, 'B': 100 * len(list_distinct(words)) < {DISTINCT_PERCENT} * len(words),
       'C': 100 * length(regexp_replace(w.text, '[^A-Z]', '', 'g')) > {CAPITAL_PERCENT} * length(w.text),
       'D': regexp_matches(w.text, '[#$%&*|]'), 'E': coalesce(m.first < w.doc_id, false)}} AS f
  FROM w JOIN m USING (text) LEFT JOIN l ON l.doc_id = w.doc_id),
c AS (SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM b GROUP BY part, f),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT p.x || q.x || s.x || t.x || u.x AS filter_order FROM x p, x q, x s, x t, x u
  WHERE len(list_distinct([p.x, q.x, s.x, t.x, u.x])) = 5),
k AS (SELECT c.*, filter_order, step, filter_order[step] AS letter, f[filter_order[step]] AS fails,
  len(list_filter(range(1, step), lambda i: f[filter_order[i]])) > 0 AS gone FROM c, o, (SELECT unnest(range(1, 6)) AS step)),
s AS (SELECT part, filter_order, step::INTEGER AS step, letter,
  coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (NOT gone AND fails), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (gone AND fails), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (fails AND len(list_filter(map_values(f), lambda v: v)) = 1), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER (NOT gone AND fails), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (NOT gone AND fails), 0)::BIGINT AS toxic_lost
  FROM k GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM s
"""
