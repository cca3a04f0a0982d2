"""Personal data: pattern spans, and terms that reveal them by corpus co-occurrence.

Base spans are the leftmost non-overlapping matches of four patterns (email, ip, card, phone), checked afterwards
(parts up to 255; 12 to 19 digits that pass Luhn; 9 to 15 digits). Each distinct value is a protected entity.
For a term ``t`` in the words of a document that names an entity ``e`` (without the words of its base spans), distinct texts are counted: with
``t`` outside spans and ``e``, with ``t`` anywhere, with ``e``, and all. Copies are no evidence: copying a corpus changes no term. The information that ``t`` gives of ``e`` is
``PMI = ln(N * n(t,e) / (n(t) * n(e)))``; as a share of all there is to know, ``IC(e) = ln(N / n(e))``, it is the term's
disclosure (1: the term occurs only with the entity). Terms are removed from ``REMOVE`` on and generalised from ``GENERALISE`` on, if so
many common documents are no chance: the hypergeometric tail (Hoeffding's bound of it, from either margin), times the number of pairs
tested, must be at most ``ALPHA``. Pairs whose counts n(t) and n(e) could not pass whatever they share are no tests (Tarone): an entity of
a single document is tested only in a corpus where 1/N would pass. Every occurrence of a disclosing term outside
base spans is marked, in every document, whether the entity is named there or not.

The patterns are written with possessive quantifiers and look-behinds, so that a long run without a match costs one pass
and no stack; they find the same matches. Positions are code points, end exclusive.

Defined results: a null text is empty; a text without spans has the empty span list. Overlapping spans of several kinds
are all listed; in the sanitised text the first (then the earlier kind) counts. Repeated rows and copies count once and each get their spans,
null ids included. Extra columns are ignored. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.bits import may_have, told_apart
from ledgerline.llm.common import save

KINDS = ("email", "ip", "card", "phone", "term")
ALPHA, GENERALISE, REMOVE = 0.05, 0.8, 0.95
#: Candidate terms up to this many are broadcast for the corpus count; more are joined by shuffling counts.
BROADCAST_TERMS = 200_000

EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
TERM = r"[\p{L}\p{N}]+"
_IP_PARTS = r"^0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})(?:\.0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})){3}$"

_SPAN = "array<struct<start:int,end:int,value:string>>"
#: Matches are added up in blocks of so many, as an array that grows is copied at each step.
_BLOCK = 128


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def spans(text: Column, pattern: str | Column) -> Column:
    """start, end and value of all matches (of one pattern, or of each row's own).

    Positions are the lengths of what lies between matches and of themselves, added up."""
    none = F.array().cast(_SPAN)
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern

    def block(part: Column, at: Column) -> Column:
        def step(done: Column, i: Column) -> Column:
            value, gap = F.element_at(part["f"], i), F.element_at(part["g"], i)
            start = done["at"] + F.char_length(gap)
            end = start + F.char_length(value)
            one = F.struct(start.alias("start"), end.alias("end"), value.alias("value"))
            return F.struct(end.alias("at"), F.concat(done["out"], F.array(one)).alias("out"))

        return F.aggregate(F.sequence(F.lit(1), F.size(part["f"])), F.struct(at.alias("at"), none.alias("out")), step)["out"]

    def size_of(part: Column) -> Column:
        add = lambda t, x: t + F.char_length(x)
        return F.aggregate(part["f"], F.aggregate(F.slice(part["g"], F.lit(1), F.size(part["f"])), F.lit(0), add), add)

    def blocks(s: Column) -> Column:
        cut = F.sequence(F.lit(0), F.floor((F.size(s["f"]) - 1) / _BLOCK).cast("int"))
        return F.transform(cut, lambda b: F.struct(F.slice(s["f"], b * _BLOCK + 1, F.lit(_BLOCK)).alias("f"), F.slice(s["g"], b * _BLOCK + 1, F.lit(_BLOCK + 1)).alias("g")))

    def laid(parts: Column) -> Column:
        begun = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        starts = F.aggregate(parts, begun, lambda d, p: F.struct((d["at"] + size_of(p)).alias("at"), F.concat(d["out"], F.array(d["at"])).alias("out")))["out"]
        return F.flatten(F.zip_with(parts, starts, block))

    both = F.struct(F.regexp_extract_all(text, pattern, F.lit(0)).alias("f"), F.split(text, pattern, -1).alias("g"))
    return F.when(F.rlike(text, pattern), _let(_let(both, blocks), laid)).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def step(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step) % 10 == 0


PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}


def checked(kind: str, value: Column) -> Column:
    """Whether a match of the kind's pattern is one."""
    count = F.length(_digits(value))
    return {"email": F.lit(True), "ip": value.rlike(_IP_PARTS), "card": luhn(_digits(value)), "phone": (count >= 9) & (count <= 15)}[kind]


def base_spans(text: Column) -> dict[str, Column]:
    """The checked spans of each kind."""
    each = lambda kind: F.filter(spans(text, PATTERNS[kind]), lambda s: checked(kind, s["value"]))
    return {kind: each(kind) for kind in PATTERNS}


def terms(text: Column) -> Column:
    """The distinct words, lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def _hidden(kind: str, value: Column) -> Column:
    return F.when(checked(kind, value), " ").otherwise(value)


def masked(text: Column) -> Column:
    """The text with a space for each base span; kind by kind, so that it costs one pass each."""
    for kind, p in PATTERNS.items():
        found = F.transform(F.regexp_extract_all(text, F.lit(p), F.lit(0)), partial(_hidden, kind))
        text = F.array_join(F.zip_with(F.split(text, p, -1), found, lambda gap, value: F.concat(gap, F.coalesce(value, F.lit("")))), "")
    return text


_ORDER = "array<struct<start:int,kind:int,end:int,value:string>>"


def _tagged(found: Column, kind: str) -> Column:
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end"), s["value"].alias("value")))


def _listed(all_spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(all_spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _key() -> Column:
    """Known by id and text: rows that agree in both get the same terms."""
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.coalesce("text", F.lit("")))
    return F.unhex(F.substring(F.sha2(named, 256), 1, 32)).alias("key")


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")


def found(docs: DataFrame, *keep: str) -> DataFrame:
    """key, h (the text's hash), doc_id, ``keep``, n_<kind>, base (the spans by start, then kind) and words (the terms beside them; none without spans), saved."""
    read = docs.select(_key(), _text_hash(), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for kind, column in base_spans(F.col("text")).items():
        read = read.withColumn(kind, column)
    read = read.withColumn("base", F.array_sort(F.concat(*(_tagged(F.col(k), k) for k in KINDS[:4]))))
    words = F.when(F.size("base") > 0, terms(masked(F.col("text")))).otherwise(F.array().cast("array<string>"))
    return save(read.select("key", "h", "doc_id", *keep, *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:4]), "base", words.alias("words")), "private")


def _entity(span: Column) -> Column:
    return F.concat_ws(":", span["kind"].cast("string"), F.when(span["kind"] >= 2, _digits(span["value"])).otherwise(F.lower(span["value"])))


def _log_chance(both: Column, draws: Column, share: Column) -> Column:
    """Hoeffding's bound of the logarithm of the chance of ``both`` or more in ``draws``; for a part above ``share``."""
    part = both / draws
    rest = F.when((part < 1) & (share < 1), (1 - part) * F.log((1 - part) / (1 - share))).otherwise(0.0)
    return -draws * (part * F.log(part / share) + rest)


def distinct_texts(docs: DataFrame, of_hash: DataFrame) -> DataFrame:
    """The text of the documents, copies once. of_hash: h and n_rows. Only texts that may have copies are moved."""
    read = docs.select(_text_hash(), F.coalesce("text", F.lit("")).alias("text"))
    copied, once = told_apart(read, of_hash.filter("n_rows > 1"), "h")
    return once.select("text").unionByName(copied.dropDuplicates(["h"]).select("text"))


def disclosing(docs: DataFrame, rows: DataFrame, alpha: float = ALPHA, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """entity, term, disclosure and removed (else generalised) of every term above the thresholds. rows: see ``found``."""
    of_hash = save(rows.groupBy("h").agg(F.count(F.lit(1)).alias("n_rows")), "texts")
    n = float(of_hash.count())
    texts = rows.filter(F.size("base") > 0).select("h", "base", "words").dropDuplicates(["h"])
    naming = texts.select(F.explode(F.array_distinct(F.transform("base", _entity))).alias("entity"), "words")
    entities = naming.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"), F.sum(F.size("words")).alias("n_tests"))
    entities = save(entities.filter(F.col("n_entity") < n), "entities")
    several = F.when(F.col("n_entity") > 1, F.col("n_tests")).otherwise(0)
    tests, least = entities.agg(F.coalesce(F.sum("n_tests"), F.lit(0)), F.coalesce(F.sum(several), F.lit(0))).first(), 1
    if tests[0] > alpha * n:  # the chance of a pair seen in one document is 1/N at least
        least = 2
    tests = max(1, tests[least - 1])
    tested = naming.join(entities.filter(F.col("n_entity") >= least).select("entity"), "entity", "left_semi")
    pairs = tested.select("entity", F.explode("words").alias("term")).groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_both"))
    pairs = save(pairs.filter(F.col("n_both") >= (1 if tests <= alpha * n else 2)), "pairs")
    wanted = pairs.select("term").distinct()
    words = distinct_texts(docs, of_hash).select(F.explode(terms(F.col("text"))).alias("term"))
    if wanted.count() <= BROADCAST_TERMS:  # else all terms are counted: tasks send a count a term, and the join below leaves the others out
        words = words.join(F.broadcast(wanted), "term", "left_semi")
    anywhere = words.groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    both, of_term, of_entity = F.col("n_both"), F.col("n_term"), F.col("n_entity")
    ratio = F.log(n * both / (of_term * of_entity)) / F.log(n / of_entity)
    chance = F.least(_log_chance(both, of_entity, of_term / n), _log_chance(both, of_term, of_entity / n))
    rated = pairs.join(anywhere, "term").join(entities, "entity").withColumn("disclosure", ratio).filter(F.col("disclosure") >= generalise)
    rated = rated.filter(chance + F.log(F.lit(float(tests))) <= F.log(F.lit(alpha)))
    return rated.select("entity", "term", "disclosure", (F.col("disclosure") >= remove).alias("removed"))


def marked(docs: DataFrame, told: DataFrame) -> DataFrame:
    """key and found_terms: all occurrences of the disclosing terms.

    A text's words are looked up first; then only the spellings that were found are cut out of it, by a pattern of its own. Texts without any stay where they are."""
    by_term = save(told.groupBy("term").agg(F.max("removed").alias("removed")), "disclosing")
    if by_term.count() <= BROADCAST_TERMS:
        by_term = F.broadcast(by_term)
    read = docs.select(_key(), F.coalesce("text", F.lit("")).alias("text"))
    spelled = F.array_distinct(F.regexp_extract_all(F.col("text"), F.lit(TERM), F.lit(0)))
    each = read.select("key", F.explode(spelled).alias("word")).withColumn("term", F.lower("word")).join(by_term, "term").select("key", "word", "removed").distinct()
    holding = save(each.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("word", "removed"))).alias("own")), "holding")
    # letters and digits only, so nothing is to be escaped
    pattern = F.concat(F.lit(r"(?<![\p{L}\p{N}])(?:"), F.array_join(F.map_keys("own"), "|"), F.lit(r")(?![\p{L}\p{N}])"))
    own_hash = F.xxhash64("key").alias("key_hash")
    held = may_have(read.select("*", own_hash), holding.select(own_hash), "key_hash").drop("key_hash")
    hits = held.join(holding, "key").select("key", "own", spans(F.col("text"), pattern).alias("w")).dropDuplicates(["key"])
    return hits.select("key", F.transform("w", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.col("own")[s["value"]].alias("removed"))).alias("found_terms"))


def private(docs: DataFrame, *keep: str, **how) -> DataFrame:
    """doc_id, n_<kind> of the base kinds, base_sha256, n_removed, n_generalised, spans, all_spans and ``keep``."""
    rows = found(docs, *keep)
    of_row = marked(docs, disclosing(docs, rows, **how))
    both = rows.join(of_row, "key", "left")
    apart = F.filter(F.col("found_terms"), lambda w: ~F.exists("base", lambda s: (w["start"] < s["end"]) & (w["end"] > s["start"])))
    shown = lambda w: F.struct(w["start"].alias("start"), F.lit(4).alias("kind"), w["end"].alias("end"), F.when(w["removed"], "removed").otherwise("generalised").alias("value"))
    both = both.withColumn("terms", F.coalesce(F.transform(apart, shown), F.array().cast(_ORDER)))
    every = F.array_sort(F.concat("base", "terms"))
    removed = F.size(F.filter("terms", lambda s: s["value"] == "removed"))
    return both.select(
        "doc_id", *(f"n_{k}" for k in KINDS[:4]), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), removed.cast("long").alias("n_removed"),
        (F.size("terms") - removed).cast("long").alias("n_generalised"), _listed(every).alias("spans"), every.alias("all_spans"), *keep,
    )


def sanitised(docs: DataFrame, **how) -> DataFrame:
    """doc_id and text: base spans replaced by their kind, removed terms dropped, generalised ones replaced by what they are."""
    names = F.array(*(F.lit(f"[{k}]") for k in KINDS))

    def step(done: Column, s: Column) -> Column:
        number = F.substring(F.col("text"), s["start"] + 1, F.lit(1)).rlike("[0-9]")
        shown = F.when(s["kind"] < 4, F.element_at(names, s["kind"] + 1)).when(s["value"] == "removed", "").otherwise(F.when(number, "[number]").otherwise("[word]"))
        put = F.struct(s["end"].alias("at"), F.concat(done["out"], F.array(F.substring(F.col("text"), done["at"] + 1, s["start"] - done["at"]), shown)).alias("out"))
        return F.when(s["start"] < done["at"], done).otherwise(put)

    begun = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    cut = F.aggregate("all_spans", begun, step)
    whole = _let(cut, lambda c: F.concat(F.array_join(c["out"], ""), F.substring(F.col("text"), c["at"] + 1, F.char_length("text"))))
    return private(docs, "text", **how).select("doc_id", F.when(F.size("all_spans") > 0, whole).otherwise(F.col("text")).alias("text"))
