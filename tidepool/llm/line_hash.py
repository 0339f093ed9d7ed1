"""Substring dedup by hashing lines and paragraphs.

A text is cut into lines and, where some stand together, paragraphs. Units are normalised and hashed; each digest's
earliest occurrence by (document id, text, place) stays. Every later one is reported, whatever its length, adjoining
ones as one run; offsets are those of the original text. A caller may leave runs of few words (stock phrases) in.

As a passage that moves to another document seldom keeps its line breaks, the sentences of lines are units too, and so
are pieces at places that the words around them choose (the least hash of any STRIDE neighbours), line breaks or not,
hashed with the words that follow: of a passage that two texts share all but STRIDE - 1 words at the start and STRIDE
at the end, at most, are found, wherever they stand. Units that hold the same words as a shorter kind at the same
place are not cut twice; spans of different kinds may overlap.

All of it is array work: a word's hash and a unit's digest are polynomials over the characters and words, taken from
running sums, so no unit's text is ever made.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from . import query
from .common import ship, table, text_hash

MIN_WORDS = 1  # words of a run that is reported: all of them
STRIDE = 12  # words of a piece at most, and words that its digest covers
GROUP = 1 << 18  # characters of short texts that are cut together
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # multipliers of the two halves of a digest
_CACHE: dict = {}


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point: whether it belongs to words, whether it is white space, and the hash of its lower case."""
    if "chars" not in _CACHE:
        points = [*range(0xD800), *range(0xE000, 0x110000)]
        every = "".join(map(chr, points))
        word, space, low = np.zeros(0x110000, bool), np.zeros(0x110000, bool), np.arange(0x110000, dtype=np.uint64)
        at = np.array(points)
        word[at[[m.start() for m in re.finditer(r"\w", every)]]] = True
        space[at[[m.start() for m in re.finditer(r"\s", every)]]] = True
        for c in filter(lambda c: c.lower() != c, every):
            low[ord(c)] = ord(c.lower()[0])
        _CACHE["chars"] = word, space, _mixed(low + np.uint64(1))
    return _CACHE["chars"]


def _powers(n: int, k: int, inverse: bool = False) -> np.ndarray:
    """The first powers of a multiplier, or of its inverse modulo 2^64."""
    have = _CACHE.get((k, inverse))
    if have is None or len(have) < n:
        base = pow(_ODD[k], -1, 1 << 64) if inverse else _ODD[k]
        steps = np.full(max(n, 1 << 14), base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps)
        if n <= 1 << 20:
            _CACHE[k, inverse] = have
    return have[:n]


def _ranges(of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the runs of equal numbers in a sorted array."""
    first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
    return first, np.concatenate((first[1:], [len(of)]))


def cut(text: str | None, sentences: bool = True) -> tuple[np.ndarray, ...] | None:
    """``cut_all`` of one text, without the first column; None if it has no words."""
    found = cut_all([text], sentences)
    return found and found[1:]


def cut_all(texts: list[str | None], sentences: bool = True) -> tuple[np.ndarray, ...] | None:
    """(number of the text, place, start, end, words, d1, d2) of the texts' units; offsets in code points.

    Lines, paragraphs, then (unless only lines and paragraphs are asked for) sentences and pieces; places count on within
    a text and a kind, and leave some out between kinds, so that runs do not go over. A digest tells the lower-case words
    in order; case, punctuation, spacing and kind do not tell, but pieces have digests of their own. The texts are
    laid out one after another, two line breaks between them, so that many short ones cost few array operations.
    """
    texts = [t or "" for t in texts]
    opens = np.cumsum([0, *(len(t) + 2 for t in texts)])
    cp = np.frombuffer("\n\n".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    is_word, is_space, low = _characters()
    word = is_word[cp]
    edge = np.flatnonzero(np.concatenate(([False], word)) != np.concatenate((word, [False])))
    starts, ends = edge[::2], edge[1::2]
    n = len(starts)
    if not n:
        return None
    size = ends - starts
    heads = np.cumsum(size) - size
    chars, within = low[cp[word]], np.arange(size.sum()) - np.repeat(heads, size)
    longest = int(size.max())
    hashes = [_mixed(np.add.reduceat(chars * _powers(longest, k)[within], heads) + size.astype(np.uint64)) for k in (0, 1)]
    sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * _powers(n, k)))) for k, h in enumerate(hashes)]

    def digests(a: np.ndarray, b: np.ndarray, kind: int = 0) -> list[np.ndarray]:
        length = (b - a).astype(np.uint64) * np.uint64(2) + np.uint64(kind)
        return [_mixed((s[b] - s[a]) * _powers(n, k, True)[a] + length).view(np.int64) for k, s in enumerate(sums)]

    solid = np.flatnonzero(~is_space[cp])
    breaks = np.flatnonzero(cp == 10)
    begin, stop = np.concatenate(([0], breaks + 1)), np.concatenate((breaks, [len(cp)]))
    first_solid = np.searchsorted(solid, begin)
    shown = np.searchsorted(solid, stop) > first_solid  # lines that are not blank
    line = np.searchsorted(breaks, starts)
    a, b = _ranges(line)
    at = solid[first_solid[line[a]]]
    out = [(np.zeros(len(a), np.int64), at, stop[line[a]], a, b)]

    # paragraphs: lines without a blank one between; those of one line with words are that line
    text_lines = np.flatnonzero(shown)
    group = np.zeros(len(begin), np.int64)
    group[text_lines] = np.cumsum(np.concatenate(([0], np.diff(text_lines) > 1)))
    of_word = group[line]
    pa, pb = _ranges(of_word)
    several = line[pa] != line[pb - 1]
    if several.any():
        pa, pb = pa[several], pb[several]
        member = group[text_lines]
        top, last = np.searchsorted(member, of_word[pa]), np.searchsorted(member, of_word[pa], "right") - 1
        out.append((np.full(len(pa), 1), solid[first_solid[text_lines[top]]], stop[text_lines[last]], pa, pb))

    if sentences:
        point = (cp[:-1] == 46) | (cp[:-1] == 33) | (cp[:-1] == 63)
        marks = np.flatnonzero(point & is_space[cp[1:]]) + 1  # a sentence ends here
        cuts = np.union1d(marks, breaks + 1)
        sa, sb = _ranges(np.searchsorted(cuts, starts, "right"))
        whole = np.isin(sa, a) & np.isin(sb, b)
        sa, sb = sa[~whole], sb[~whole]
        if len(sa):
            k = np.searchsorted(cuts, starts[sa], "right")
            left = np.concatenate(([0], cuts))[k]
            right = np.concatenate((cuts, [len(cp) + 1]))[k]
            right = np.minimum(right, stop[line[sa]])  # not the line break itself
            out.append((np.full(len(sa), 2), solid[np.searchsorted(solid, left)], right, sa, sb))
    units = [np.concatenate(x) for x in zip(*out)]
    found = [units[0], units[1], units[2], units[4] - units[3], *digests(units[3], units[4])]
    if sentences and n > STRIDE:
        h = hashes[0]
        h = (h[:-1] * np.uint64(_ODD[0]) + h[1:]) * np.uint64(0xBF58476D1CE4E5B9)  # of two words
        least = h >> np.uint64(32) << np.uint64(32) | np.arange(n - 1, 0, -1, dtype=np.uint64)  # of equals the last is least
        width = 1
        while width < STRIDE:  # the least of the next ``width``
            step = min(width, STRIDE - width)
            least, width = np.minimum(least[:-step], least[step:]), width + step
        own = np.searchsorted(opens, starts, "right")
        inside = own[: len(least)] == own[STRIDE:]  # windows within one text
        chosen = n - 1 - (least[inside] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        chosen = chosen[np.diff(chosen, prepend=-1) != 0]
        until = np.searchsorted(own, own[chosen], "right")  # the end of the text
        nxt = np.minimum(np.concatenate((chosen[1:], [n])), np.minimum(until, chosen + STRIDE))
        fits = chosen + STRIDE <= until
        chosen, nxt = chosen[fits], nxt[fits]
        more = (np.full(len(chosen), 3), starts[chosen], ends[nxt - 1], nxt - chosen, *digests(chosen, chosen + STRIDE, 1))
        found = [np.concatenate(x) for x in zip(found, more)]
    kind, at, to = found[:3]
    text = np.searchsorted(opens, at, "right") - 1
    first = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (kind[1:] != kind[:-1]))))
    rank = np.arange(len(text)) - np.repeat(first, np.diff(np.concatenate((first, [len(text)]))))
    return text, (kind << 29) + rank, at - opens[text], to - opens[text], *found[3:]


def units(docs: DataFrame, id_col: str, text_col: str, unit: str) -> DataFrame:
    """(id, text_hash, spot, mark, d1, d2): a row for each unit; spot packs start and end, mark the place and the words."""
    import pyarrow as pa

    kind = docs.schema[id_col].dataType.simpleString()
    if unit not in ("line", "sentence"):
        raise ValueError(f"unit {unit}")
    ship(docs.sparkSession)

    def rows(part, first, texts):
        found = cut_all(texts, unit == "sentence")
        if not found:
            return
        of, place, at, to, words, d1, d2 = found
        for k in range(0, len(of), 1 << 17):
            s = slice(k, k + (1 << 17))
            own = [part.column(c).take(pa.array(of[s] + first)) for c in (0, 2)]
            cols = [at[s] << 32 | to[s], place[s] << 32 | words[s], d1[s], d2[s]]
            yield pa.RecordBatch.from_arrays([*own, *map(pa.array, cols)], names=["id", "text_hash", "spot", "mark", "d1", "d2"])

    def run(batches):
        for part in batches:
            first, held, weight = 0, [], 0
            for k in range(part.num_rows):
                text = part.column(1)[k].as_py()
                if held and weight + len(text or "") > GROUP:
                    yield from rows(part, first, held)
                    first, held, weight = k, [], 0
                held.append(text)
                weight += len(text or "")
            if held:
                yield from rows(part, first, held)

    picked = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), text_hash(text_col))
    return picked.mapInArrow(run, f"id {kind}, text_hash bigint, spot bigint, mark bigint, d1 bigint, d2 bigint")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "sentence",
                   min_words: int = MIN_WORDS) -> DataFrame:
    """(id, text_hash, start, end, n_units, n_words, first_ids): runs of repeated units, first_ids the ids that keep them.

    Null and empty texts have no units. Null ids rank last. Rows that repeat id and text are one document: they rank
    alike, so a unit that is earliest in one stays in all. ``unit`` "line" leaves sentences and pieces out. A table without repeats, or an empty one, gives an
    empty table; other columns are not looked at.

    A digest that a third of all rows share meets in one combined aggregate and then in a join with one row a
    digest on the other side, which adaptive execution splits; what remains is grouped by document.
    """
    own = units(docs, id_col, text_col, unit)
    place = F.struct(F.isnull("id").alias("u"), F.col("id"), F.col("text_hash"), F.col("spot"))
    first = own.groupBy("d1", "d2").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1")
    first = stored(first.select(F.col("d1").alias("f1"), F.col("d2").alias("f2"), "first"))  # so that the join can split
    met = own.join(first, (F.col("d1") == F.col("f1")) & (F.col("d2") == F.col("f2")))
    low = F.lit((1 << 32) - 1)
    again = met.where(~F.col("first").eqNullSafe(place)).select(
        "id", "text_hash", "first", F.shiftright("spot", 32).cast("int").alias("at"), F.col("spot").bitwiseAND(low).cast("int").alias("to"),
        F.shiftright("mark", 32).cast("int").alias("idx"), F.col("mark").bitwiseAND(low).alias("words"))
    doc = Window.partitionBy("id", "text_hash").orderBy("idx")
    runs = again.withColumn("run", F.col("idx") - F.dense_rank().over(doc)).groupBy("id", "text_hash", "run").agg(
        F.min("at").alias("start"), F.max("to").alias("end"), (F.max("idx") - F.min("idx") + 1).cast("bigint").alias("n_units"),
        F.sum("words").alias("all_words"), F.count("*").alias("rows"), F.array_sort(F.collect_set("first.id")).alias("first_ids"))
    words = F.expr("all_words div (rows div n_units)")  # rows that repeat a document count once
    return runs.withColumn("n_words", words).where(F.col("n_words") >= min_words).select(
        F.col("id").alias(id_col), "text_hash", "start", "end", "n_units", "n_words", "first_ids")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "sentence",
                   min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the repeated spans, and with a column ``removed`` of their original (start, end)."""

    @F.pandas_udf("string")
    def cut(texts, spans):
        def one(text, out):
            if text is None or out is None or not len(out):
                return text
            kept, at = [], 0
            for x in sorted(out, key=lambda x: x["start"]):
                kept.append(text[at : x["start"]])
                at = max(at, x["end"])
            return "".join(kept) + text[at:]

        return texts.combine(spans, one)

    ship(docs.sparkSession)
    spans = repeated_spans(docs, id_col, text_col, unit, min_words)
    spans = spans.groupBy(F.col(id_col).alias("_tk_id"), F.col("text_hash").alias("_tk_hash")).agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("removed"))
    left = docs.withColumns({"_tp_id": F.col(f"`{id_col}`"), "_tp_hash": text_hash(text_col)})
    on = F.col("_tp_id").eqNullSafe(F.col("_tk_id")) & F.col("_tp_hash").eqNullSafe(F.col("_tk_hash"))
    out = left.join(spans, on, "left")
    return out.withColumn(text_col, cut(F.col(f"`{text_col}`"), F.col("removed"))).select(
        *(F.col(f"`{c}`") for c in docs.columns if c != "removed"), "removed")


@query("op3_substring_dedup")
def op3_substring_dedup(spark, sf_dir):
    """Repeated passages of every whole text of documents: a row for each span that goes."""
    return repeated_spans(table(spark, sf_dir, "documents")).drop("text_hash")
