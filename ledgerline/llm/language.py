"""Language identification by cross-parsing: suffix automata of labelled text, fewest phrases win.

For each language one suffix automaton is built from the most frequent words of all its labelled
documents (their number is bounded). A text is cut into lower-case letter runs, each marked with a space at both ends, and parsed
greedily against every automaton: each phrase is the longest match that the automaton has (a character
that it lacks is a phrase by itself). ``phrases * log2(reference length) / letters`` estimates the cross
entropy in bits a letter; the language with the least wins. Phrases end at word ends, so the counts of a
word are computed once and kept.

Defined results: ``und`` with score 0 for a null or empty text, one without letters, or when nothing was
learned. Ties go to the language with more labelled documents, then to the first name. The score is
``other / (best + other)`` of the two least entropies (0.5 for a tie, 1.0 for a sole language). Repeated
rows are judged each for itself; other columns are ignored.

``placed`` keeps the documents that have a language. A text of another one, or in a script that no automaton has, needs about a phrase a
letter; ``most_bits`` learns from all labelled texts how far below that labelled texts stay, and texts of ``MIN_LETTERS``
letters or more beyond the middle of the two go as well.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.bits import told_apart
from ledgerline.llm.common import held_out, in_slices, kept_alone, save, texts

UNKNOWN = "und"
#: Bound of the model: distinct words of each language, the most frequent ones of all its documents. All languages are learned: beyond
#: ``FULL_SAMPLES`` of them each gets fewer words, so that the whole stays as large; more than ``MAX_LANGUAGES`` labels are an error.
SAMPLE_WORDS, FULL_SAMPLES, MAX_LANGUAGES = 8000, 200, 10_000
#: Letters that a text needs to be judged foreign.
MIN_LETTERS = 20
_RUNS = re.compile(r"[^\W\d_]+").findall


def letter_runs(text: str) -> list[str]:
    """Runs of letters as ``str.isalpha`` has them: word characters without digits, the underscore and other numerals (superscripts, fractions)."""
    runs = _RUNS(text)
    if all(map(str.isalpha, runs)):
        return runs
    return "".join(c if c.isalpha() else " " for c in " ".join(runs)).split()


#: Words whose phrase counts a worker keeps; beyond that it starts anew.
KEPT_WORDS = 400_000
_FIELD = 48


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the minimal automaton of all substrings of ``text``; state 0 is the start."""
    moves: list[dict[str, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in text:
        new = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return moves


def phrases(moves: list[dict[str, int]], text: str) -> int:
    """Phrases of the greedy parse of ``text`` into longest matches."""
    count, state = 0, 0
    for c in text:
        to = moves[state].get(c)
        if to is None:
            count += state > 0
            to = moves[0].get(c, 0)
            count += to == 0
        state = to
    return count + (state > 0)


@dataclass(frozen=True)
class Reference:
    """Languages in order of preference, and each one's reference text (its words with spaces around)."""

    languages: tuple[str, ...]
    texts: tuple[str, ...]


def _labelled(docs: DataFrame) -> DataFrame:
    return docs.filter(_is_labelled())


def _is_labelled() -> Column:
    return F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))


def _is_long() -> Column:
    return F.length(F.regexp_replace("text", r"\P{L}+", "")) >= MIN_LETTERS


def _sample_ids(known: DataFrame, sample_docs: int) -> DataFrame:
    """lang and doc_id of the labelled documents of each language with the least hash of the id."""
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    ranked = known.select("lang", "doc_id", F.xxhash64("doc_id").alias("h")).withColumn("r", F.row_number().over(order))
    return ranked.filter(F.col("r") <= sample_docs).select("lang", "doc_id").distinct()


def learn(docs: DataFrame, sample_docs: int | None = None, sample_words: int = SAMPLE_WORDS, full_samples: int = FULL_SAMPLES, max_languages: int = MAX_LANGUAGES) -> Reference:
    """The references from the documents with a language that are not held out.

    Words are counted over all these documents; of each language's the most frequent come to the driver, bounded by the parameters.
    Only where ``sample_docs`` is given are they counted over that many documents of a language, those with the least hash of the id.
    """
    known = _labelled(docs)
    top = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages + 1).collect()
    if len(top) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    if not top:
        return Reference((), ())
    fewer = max(1, -(-len(top) // full_samples))
    sample_words = -(-sample_words // fewer)
    if sample_docs:
        known = known.join(F.broadcast(_sample_ids(known, -(-sample_docs // fewer))), ["lang", "doc_id"])
    words = (
        known.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), 1)).alias("word"))
        .groupBy("lang", "word").count()
    )
    best = words.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("count"), "word"))).filter(F.col("r") <= sample_words)
    got: dict[str, list[tuple[int, str]]] = {}
    for r in best.select("lang", "r", "word").collect():
        got.setdefault(r.lang, []).append((r.r, r.word))
    names = [r.lang for r in top if r.lang in got]
    return Reference(tuple(names), tuple(" " + " ".join(w for _, w in sorted(got[n])) + " " for n in names))


class Parser:
    """The automata of a reference, with the phrase counts of words seen: one field of a long integer each."""

    def __init__(self, reference: Reference):
        self.languages = reference.languages
        self.bits = [math.log2(max(2, len(t))) for t in reference.texts]
        self.automata = [suffix_automaton(t) for t in reference.texts]
        self.known = _Known(self)

    def count(self, word: str) -> int:
        marked = f" {word} "
        return sum(phrases(moves, marked) << (_FIELD * i) for i, moves in enumerate(self.automata))

    def predict(self, text: str) -> tuple[str, float, float]:
        """Language, score, and the least entropy (bits a letter)."""
        return self.judged(text)[:3]

    def judged(self, text: str) -> tuple[str, float, float, int]:
        """Language, score, the least entropy (bits a letter), and the number of letters."""
        words = letter_runs(text.lower())
        if not words or not self.languages:
            return UNKNOWN, 0.0, 0.0, sum(map(len, words))
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        packed = sum(map(self.known.__getitem__, words))
        letters = sum(map(len, words))
        mask = (1 << _FIELD) - 1
        bits = [(packed >> (_FIELD * i) & mask) * b / letters for i, b in enumerate(self.bits)]
        best = min(range(len(bits)), key=lambda i: (bits[i], i))
        if len(bits) == 1:
            return self.languages[best], 1.0, bits[best], letters
        other = min(b for i, b in enumerate(bits) if i != best)
        return self.languages[best], other / (bits[best] + other), bits[best], letters

    def placed(self, text: str, below: float) -> bool:
        """Whether the text has a language: see ``most_bits``."""
        lang, _, bits, letters = self.judged(text)
        return lang != UNKNOWN and (bits < below or letters < MIN_LETTERS)


class _Known(dict):
    def __init__(self, parser: Parser):
        super().__init__()
        self.parser = parser

    def __missing__(self, word: str) -> int:
        self[word] = n = self.parser.count(word)
        return n


def _parser(reference: Reference) -> Parser:
    """One parser for each worker process; the automata are built once there."""
    return kept_alone(reference, lambda: Parser(reference))


def identify(docs: DataFrame, reference: Reference, *keep: str) -> DataFrame:
    """``keep`` columns of the documents (default doc_id), then lang_pred, score and bits (a letter)."""
    keep = keep or ("doc_id",)
    if "text" not in keep:
        source = docs.select(*keep, "text")
    else:
        source = docs.select(*keep)
    shared = docs.sparkSession.sparkContext.broadcast(reference)  # bounded: see learn()

    def run(parts):
        parser = _parser(shared.value)
        for batch in in_slices(parts):
            found = [parser.predict(t) for t in texts(batch)]
            columns = [batch.column(c) for c in keep]
            for k, kind in enumerate((pa.string(), pa.float64(), pa.float64())):
                columns.append(pa.array([x[k] for x in found], kind))
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "lang_pred", "score", "bits"])

    return source.mapInArrow(run, _ddl(docs.select(*keep)) + ", lang_pred string, score double, bits double")


def most_bits(docs: DataFrame, reference: Reference) -> float:
    """The bits a letter from which a text is foreign: midway between the worst of all labelled texts and a phrase a letter.

    Infinite where a labelled text needs that much itself, or nothing was learned."""
    if not reference.languages:
        return math.inf
    return _midway(reference, identify(_labelled(docs).filter(_is_long()), reference, "doc_id").agg(F.max("bits")).first()[0] or 0.0)


def _midway(reference: Reference, worst: float) -> float:
    alone = min(math.log2(max(2, len(t))) for t in reference.texts)
    return (worst + alone) / 2 if worst < alone else math.inf


def placed(docs: DataFrame, reference: Reference, below: float = math.inf) -> DataFrame:
    """The documents, all their columns, that have a language: any but ``und``, at fewer bits a letter than ``below`` (see ``most_bits``)."""
    shared = docs.sparkSession.sparkContext.broadcast(reference)

    def run(parts):
        parser = _parser(shared.value)
        for batch in in_slices(parts):
            yield batch.filter(pa.array([parser.placed(t, below) for t in texts(batch)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def with_language(docs: DataFrame, reference: Reference) -> DataFrame:
    """``placed`` below ``most_bits``. All texts are parsed once, for a table of numbers; a second time only those that may go, as a bit table of their hashes tells."""
    if not reference.languages:
        return docs.limit(0)
    shared = docs.sparkSession.sparkContext.broadcast(reference)
    schema = pa.schema([("h", pa.int64()), ("counts", pa.bool_()), ("bits", pa.float64()), ("letters", pa.int64())])

    def run(parts):
        parser = _parser(shared.value)
        for batch in in_slices(parts):
            found = [parser.judged(t) for t in texts(batch)]
            bits = pa.array([None if lang == UNKNOWN else x for lang, _, x, _ in found], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("counts"), bits, pa.array([n for *_, n in found], pa.int64())], schema=schema)

    counts = _is_labelled() & _is_long()
    read = docs.select("text", F.xxhash64("text").alias("h"), F.coalesce(counts, F.lit(False)).alias("counts"))
    parsed = save(read.mapInArrow(run, "h long, counts boolean, bits double, letters long"), "parsed")
    below = _midway(reference, parsed.filter("counts").agg(F.max("bits")).first()[0] or 0.0)
    gone = parsed.filter(F.col("bits").isNull() | ((F.col("bits") >= below) & (F.col("letters") >= MIN_LETTERS))).select("h")
    # the row goes along as one struct, so that none of its columns can clash with the hash
    may, stay = told_apart(docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64("text").alias("h")), gone, "h")
    return stay.select("row.*").unionByName(placed(may.select("row.*"), reference, below))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
