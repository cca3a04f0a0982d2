"""Temperature mixing of sources: an exponent on their token shares, found by bisection, and block permutations.

A source with share ``p`` of all tokens gets the weight ``p^a / sum(p^a)``. The exponent ``a`` between 0 (all
sources alike) and 1 (as they are) is bisected over multiples of 2^-20: the least one at which no source
is shown more than ``max_repeats`` times, or the greatest one at which the weights' entropy (nats) reaches
``target_entropy``. The budget is given in tokens, or (None) is the least one that shows every source at least once.

Realisation: the documents of a source are dealt into blocks of about ``BLOCK_DOCS`` by a hash of the id. Each epoch
is a permutation of the blocks and, within a block, of its documents (by hashes of seed, epoch and id). A
source whose quota is ``full`` whole epochs and a rest gets those epochs and, of one more, the documents before the
first that no longer fits the rest. That cut is a pair of keys for each source, so rows are chosen where they lie:
texts are neither shuffled nor sorted. ``turn`` (0 to 1) orders the whole mixture: sorted by it, by block_key and
doc_key, every stretch has about the target weights.

Defined results: a null source is a source of its own. Null and empty texts have no tokens; sources without tokens get
no weight and are left out. With null ids the md5 of the text stands for the id. Repeated rows are repeated in each
epoch; at the cut they are all in or all out. An empty table gives no rows. Extra columns stay untouched.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import WORD, save

MAX_REPEATS, BLOCK_DOCS, SEED = 2.0, 1000, 17
#: The exponent's grid is 2^-20; each round looks at 32 points between two neighbours of the last.
_GRID, _POINTS = 1 << 20, 32
#: Source tables up to this many rows are broadcast; larger ones are joined by shuffling.
BROADCAST_SOURCES = 50_000
_NONE = "\x00"


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(*parts: Column) -> Column:
    """60 bits of the md5 of the parts, joined by colons."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def _identity() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce(F.col("text"), F.lit(""))))


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, source, the source's key, the identity that is hashed, and n_tokens of every document."""
    return docs.select("doc_id", "source", F.coalesce("source", F.lit(_NONE)).alias("mix_source"), _identity().alias("mix_id"), n_tokens(F.col("text")).alias("n_tokens"))


def exponent(sources: DataFrame, max_repeats: float | None = MAX_REPEATS, target_entropy: float | None = None, budget: int | None = None) -> float:
    """Bisect the exponent. sources: mix_source, tokens. Each round is one aggregate over the sources."""
    low, high = 0, _GRID  # the answer lies in (low, high] of the grid (repeats) or [low, high) (entropy)
    total = sources.agg(F.sum("tokens")).first()[0]
    if not total:
        return 1.0
    p = F.col("tokens") / F.lit(total)

    def fits(points: list[int]) -> dict[int, bool]:
        each = sources.filter(F.col("tokens") > 0).select(p.alias("p"), "tokens", F.explode(F.array(*map(F.lit, points))).alias("k"))
        raised = F.pow("p", F.col("k") / F.lit(_GRID))
        sums = each.withColumn("w", raised).groupBy("k").agg(F.sum("w").alias("z"), F.sum(F.col("w") * F.log("p")).alias("wl"), F.max(F.col("w") / F.col("tokens")).alias("most"), F.min(F.col("w") / F.col("tokens")).alias("least"))
        if target_entropy is not None:
            ok = F.log("z") - F.col("k") / F.lit(_GRID) * F.col("wl") / F.col("z") >= F.lit(target_entropy)
        else:
            repeats = F.col("most") / F.col("least") if budget is None else F.col("most") / F.col("z") * F.lit(float(budget))
            ok = repeats <= F.lit(float(max_repeats))
        return {r.k: r.ok for r in sums.select("k", ok.alias("ok")).collect()}

    rising = target_entropy is None  # repeats fall as the exponent rises: take the least that fits
    ends = fits([low, high])
    if rising and ends[low]:
        return 0.0
    if not rising and ends[high]:
        return 1.0
    if (rising and not ends[high]) or (not rising and not ends[low]):
        return 1.0 if rising else 0.0
    while high - low > 1:
        points = sorted({low + (high - low) * k // _POINTS for k in range(1, _POINTS)} - {low, high})
        ok = fits(points)
        if rising:
            first = next((x for x in points if ok[x]), high)
            low, high = max([low, *(x for x in points if x < first)]), first
        else:
            last = max([low, *(x for x in points if ok[x])])
            low, high = last, min([high, *(x for x in points if x > last)])
    return (high if rising else low) / _GRID


def plan(docs: DataFrame, max_repeats: float | None = MAX_REPEATS, target_entropy: float | None = None, budget: int | None = None, block_docs: int = BLOCK_DOCS, seed: int = SEED) -> DataFrame:
    """One row for each source: tokens, docs, weight, quota, repeats, n_blocks, full (epochs), and the cut of the last epoch.

    docs: as ``counted`` gives them (best saved, as it is read three times)."""
    sources = save(docs.groupBy("mix_source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")).filter(F.col("tokens") > 0), "sources")
    a = exponent(sources, max_repeats, target_entropy, budget)
    total = sources.agg(F.sum("tokens")).first()[0] or 1
    raised = sources.withColumn("raised", F.pow(F.col("tokens") / F.lit(total), F.lit(a)))
    z, scale = raised.agg(F.sum("raised"), F.max(F.col("tokens") / F.col("raised"))).first()
    z, scale = z or 1.0, scale or 0.0
    wanted = F.col("raised") * F.lit(scale) if budget is None else F.col("raised") / F.lit(z) * F.lit(float(budget))
    most = F.col("tokens") * F.lit(float(max_repeats)) if max_repeats else wanted
    quotas = (
        raised.withColumn("weight", F.col("raised") / F.lit(z)).withColumn("quota", F.round(F.least(wanted, most)).cast("long"))
        .withColumn("full", F.expr("quota div tokens")).withColumn("rest", F.expr("quota % tokens"))
        .withColumn("n_blocks", F.ceil(F.col("docs") / F.lit(block_docs)).cast("long")).withColumn("exponent", F.lit(a)).drop("raised")
    )
    # the cut: first the block in which the rest ends, then the first document of that block that does not fit
    in_last = _with(docs, quotas, "full", "rest", "n_blocks").filter(F.col("rest") > 0)
    keyed = in_last.withColumn("block", F.pmod(_key(F.lit("block"), F.col("mix_id")), F.col("n_blocks")))
    keyed = keyed.withColumn("block_key", _block_key(seed, F.col("full")))
    blocks = keyed.groupBy("mix_source", "rest", "block_key").agg(F.sum("n_tokens").alias("in_block"))
    ends = blocks.withColumn("end", F.sum("in_block").over(Window.partitionBy("mix_source").orderBy("block_key")))
    cut = ends.filter(F.col("end") > F.col("rest")).groupBy("mix_source").agg(F.min(F.struct("block_key", F.col("rest") - F.col("end") + F.col("in_block"))).alias("c"))
    cut = cut.select("mix_source", F.col("c.block_key").alias("cut_block"), F.col("c.col2").alias("left"))
    inside = keyed.join(cut, "mix_source").filter(F.col("block_key") == F.col("cut_block")).withColumn("doc_key", _doc_key(seed, F.col("full")))
    each = inside.groupBy("mix_source", "left", "doc_key").agg(F.sum("n_tokens").alias("here"))
    over = each.withColumn("end", F.sum("here").over(Window.partitionBy("mix_source").orderBy("doc_key"))).filter(F.col("end") > F.col("left"))
    cuts = over.groupBy("mix_source").agg(F.min("doc_key").alias("cut_doc"))
    out = quotas.join(cut.drop("left"), "mix_source", "left").join(cuts, "mix_source", "left")
    return save(out.withColumn("repeats", F.col("quota") / F.col("tokens")), "mixture")


def _block_key(seed: int, epoch: Column) -> Column:
    return _key(F.lit(f"{seed}:blocks"), F.col("mix_source"), epoch.cast("string"), F.col("block").cast("string"))


def _doc_key(seed: int, epoch: Column) -> Column:
    return _key(F.lit(f"{seed}:docs"), epoch.cast("string"), F.col("mix_id"))


def _with(rows: DataFrame, sources: DataFrame, *columns: str) -> DataFrame:
    """Rows with their source's columns. The sources are counted first and broadcast only if few."""
    side = sources.select("mix_source", *columns)
    if sources.count() <= BROADCAST_SOURCES:
        side = F.broadcast(side)
    return rows.join(side, "mix_source")


def realise(rows: DataFrame, mixture: DataFrame, seed: int = SEED) -> DataFrame:
    """The rows (with mix_source and mix_id), once for each epoch that shows them: adds epoch, block, block_key, doc_key, turn."""
    of = ("full", "rest", "n_blocks", "repeats", "cut_block", "cut_doc")
    epochs = F.sequence(F.lit(0).cast("long"), F.col("full") + F.when(F.col("rest") > 0, 1).otherwise(0) - 1)
    shown = _with(rows, mixture, *of).filter((F.col("full") > 0) | (F.col("rest") > 0))
    keyed = (
        shown.withColumn("block", F.pmod(_key(F.lit("block"), F.col("mix_id")), F.col("n_blocks"))).withColumn("epoch", F.explode(epochs))
        .withColumn("block_key", _block_key(seed, F.col("epoch"))).withColumn("doc_key", _doc_key(seed, F.col("epoch")))
    )
    before = (F.col("block_key") < F.col("cut_block")) | ((F.col("block_key") == F.col("cut_block")) & (F.col("doc_key") < F.col("cut_doc")))
    kept = keyed.filter((F.col("epoch") < F.col("full")) | F.coalesce(before, F.lit(False)))
    turn = (F.col("epoch") + F.col("block_key") / F.lit(float(1 << 60))) / F.col("repeats")
    return kept.withColumn("turn", turn).drop(*of)


def mixed(docs: DataFrame, **how) -> DataFrame:
    """doc_id, source, epoch, block, n_tokens, turn, block_key and doc_key of every document shown in the mixture."""
    rows = save(counted(docs), "counted")
    seed = how.get("seed", SEED)
    return realise(rows, plan(rows, **how), seed).select("doc_id", "source", "epoch", "block", "n_tokens", "turn", "block_key", "doc_key")


def mixed_rows(docs: DataFrame, in_turn: bool = False, **how) -> DataFrame:
    """The documents' own columns, each row once for each epoch that shows it.

    ``in_turn`` lays the rows out in the order of the mixture: range-partitioned by turn and sorted, so that files written from it follow it."""
    rows = save(counted(docs), "counted")
    names = docs.columns
    # the row goes along as one struct, so that none of its columns can clash with those added here
    packed = docs.select(F.struct(*names).alias("mix_row"), F.coalesce("source", F.lit(_NONE)).alias("mix_source"), _identity().alias("mix_id"))
    shown = realise(packed, plan(rows, **how), how.get("seed", SEED))
    if in_turn:
        shown = shown.repartitionByRange("turn", "block_key", "doc_key").sortWithinPartitions("turn", "block_key", "doc_key")
    return shown.select("mix_row.*")


#: The same in DuckDB SQL, for the production parameters.
SQL = f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, source, coalesce(source, chr(0)) AS s, coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, ''))) AS id,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS n FROM documents),
src AS (SELECT s, CAST(sum(n) AS BIGINT) AS tokens, count(*) AS docs FROM rows GROUP BY s HAVING sum(n) > 0),
p AS (SELECT s, tokens, docs, tokens / (SELECT sum(tokens) FROM src) AS p FROM src),
fit(low, high) AS (
  SELECT CASE WHEN (SELECT max(pow(p, 0.0) / tokens) / min(pow(p, 0.0) / tokens) FROM p) <= {MAX_REPEATS} THEN -1 ELSE 0 END, CASE WHEN (SELECT max(pow(p, 0.0) / tokens) / min(pow(p, 0.0) / tokens) FROM p) <= {MAX_REPEATS} THEN 0 ELSE {_GRID} END
  UNION ALL
  SELECT CASE WHEN ok THEN low ELSE mid END, CASE WHEN ok THEN mid ELSE high END
  FROM (SELECT low, high, (low + high) // 2 AS mid, (SELECT max(pow(p, ((low + high) // 2) / {_GRID}) / tokens) / min(pow(p, ((low + high) // 2) / {_GRID}) / tokens) FROM p) <= {MAX_REPEATS} AS ok FROM fit WHERE high - low > 1)),
a AS (SELECT high / {_GRID} AS a FROM fit WHERE high - low = 1),
r AS (SELECT s, tokens, docs, pow(p, (SELECT a FROM a)) AS raised FROM p),
q AS (SELECT s, tokens, docs, CAST(round(least(raised * (SELECT max(tokens / raised) FROM r), tokens * {MAX_REPEATS})) AS BIGINT) AS quota FROM r),
m AS (SELECT s, quota // tokens AS full_epochs, quota % tokens AS rest, quota / tokens AS repeats, CAST(ceil(docs / {BLOCK_DOCS}) AS BIGINT) AS n_blocks FROM q),
k AS (SELECT rows.*, m.*  EXCLUDE (s), CAST('0x' || md5('block:' || id)[1:15] AS BIGINT) % n_blocks AS block FROM rows JOIN m USING (s)),
e AS (SELECT *, unnest(range(full_epochs + CASE WHEN rest > 0 THEN 1 ELSE 0 END)) AS epoch FROM k),
o AS (SELECT *, CAST('0x' || md5('{SEED}:blocks:' || s || ':' || epoch || ':' || block)[1:15] AS BIGINT) AS block_key, CAST('0x' || md5('{SEED}:docs:' || epoch || ':' || id)[1:15] AS BIGINT) AS doc_key FROM e),
c AS (SELECT *, sum(n) OVER (PARTITION BY s, epoch ORDER BY block_key, doc_key RANGE UNBOUNDED PRECEDING) AS upto FROM o),
f AS (SELECT s, epoch, min(struct_pack(b := block_key, d := doc_key)) AS cut FROM c WHERE epoch = full_epochs AND upto > rest GROUP BY s, epoch)
SELECT doc_id, source, epoch, block, n AS n_tokens, (epoch + block_key / CAST({1 << 60} AS DOUBLE)) / repeats AS turn, block_key, doc_key
FROM c LEFT JOIN f USING (s, epoch) WHERE epoch < full_epochs OR struct_pack(b := block_key, d := doc_key) < cut
"""
