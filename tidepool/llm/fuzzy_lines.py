"""Fuzzy line dedup: MinHash over character shingles, banding, exact Jaccard, union-find.

One-permutation MinHash: each shingle's hash picks one of BANDS * ROWS bins, a bin keeps its least hash, an empty
bin borrows from the next full one. A pair of lines with Jaccard similarity 0.8 shares at least one of
14 bands of 5 bins with a chance of 0.996. Equal lines collapse to one before banding; buckets with one line
are dropped, and buckets with the same lines as another are looked at once. Lines in a bucket are compared by
their whole shingle sets, searching on from each line found, and the links are joined to components.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, stored
from . import query
from .common import map_rows, ship, table, text_hash
from .components import connected_components

SHINGLE = 7
BANDS, ROWS = 14, 5
SIMILARITY = 0.8
BITS = 1 << 26  # of the map that marks lines with a neighbour in some bucket: 8 MB
BLOCK = 1000  # lines of a bucket that are compared in one place; larger buckets are compared block by block
STRETCH = 1 << 17  # characters that are hashed at once
BINS = 256  # ranges of hashes, told by their first 8 bits: what two lines can share in each bounds what they share
FEW = 2  # lines up to which a bucket is compared without looking at the bound
REMEMBERED = 1 << 19  # lines after which a task forgets those that it has banded; equal ones then go twice
_MUL = np.uint64(0x9E3779B97F4A7C15)
_POWERS = [np.uint64(pow(0x100000001B3, k, 1 << 64)) for k in range(4)]
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
# white space other than the space and the line break, in Latin-1; beyond ASCII in UTF-8
_TABS = b"\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0"
_WIDE = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")
_GAPS = re.compile(b"\xe2\x80[\x80-\x8a\xa8\xa9\xaf]")


def normalised(line: str) -> str:
    """Lower case, white space as single spaces, none at the ends."""
    return " ".join(line.lower().split())


def _only_spaces(text: str) -> bool:
    """Whether the white space of a text is spaces and line breaks."""
    try:
        return len(text.encode("latin-1").translate(None, _TABS)) == len(text)
    except UnicodeEncodeError:
        b = text.encode("utf-8", "surrogatepass")
        return len(b.translate(None, _TABS[:8])) == len(b) and not (any(w in b for w in _WIDE) or _GAPS.search(b))


def lines_of(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, normalised) of the lines that are not blank, offsets in code points.

    A line is taken apart at its white space only if some of that has to go.
    """
    text = text or ""
    out, at, plain = [], 0, _only_spaces(text)
    for line in text.split("\n"):
        norm = line.lower()
        if not plain or "  " in norm or norm[:1] == " " or norm[-1:] == " ":
            norm = normalised(line)
        if norm:
            out.append((at, at + len(line), norm))
        at += len(line) + 1
    return out


def line_ids(norms: list[str]) -> list[int]:
    from xxhash import xxh3_64_intdigest as digest

    return np.array([digest(s.encode("utf-8", "surrogatepass")) for s in norms], np.uint64).view(np.int64).tolist()


def _mixed(x: np.ndarray) -> np.ndarray:
    y = x >> np.uint64(31)
    y ^= x
    y *= _MUL
    return y ^ (y >> np.uint64(29))


def shingle_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The shingles' hashes of some lines, line by line, and the number of each line's; a line shorter than a shingle is one.

    What runs from a line into the next is _NONE and counts to the line: SHINGLE - 1 at the end of each but the last.
    """
    count = np.array([max(len(s), SHINGLE) for s in lines])
    text = "".join(s if len(s) >= SHINGLE else s.ljust(SHINGLE, "\0") for s in lines)
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    n = len(c) - SHINGLE + 1
    two = c[:-1] * _POWERS[1]
    two += c[1:]
    four = two[:-2] * _POWERS[2]
    four += two[2:]
    h = four[:n] * _POWERS[3]  # 4 + 2 + 1 characters
    h += two[4 : 4 + n] * _POWERS[1]
    h += c[6 : 6 + n]
    h = _mixed(h)
    h[(np.cumsum(count)[:-1, None] - np.arange(1, SHINGLE)).ravel()] = _NONE
    count[-1] -= SHINGLE - 1
    return h, count


def shingle_sets(lines: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """The different shingle hashes of each line, ascending, and their numbers in BINS ranges; all lines are hashed at once."""
    h, count = shingle_hashes(lines)
    ends = np.cumsum(count)
    for a, b in zip((ends - count).tolist(), ends.tolist()):
        h[a:b].sort()
    new = h != _NONE
    new[1:] &= h[1:] != h[:-1]
    owner = np.repeat(np.arange(len(lines)), count)[new]
    h = h[new]
    spread = np.bincount(owner * BINS + (h >> np.uint64(56)).view(np.int64), minlength=len(lines) * BINS).reshape(len(lines), BINS).astype(np.int32)
    return np.split(h, np.searchsorted(owner, np.arange(1, len(lines)))), spread


def band_keys(lines: list[str]) -> np.ndarray:
    """A row of BANDS keys for each line."""
    bins = BANDS * ROWS
    h, count = shingle_hashes(lines)
    least = np.full(len(lines) * bins, _NONE)
    slot = h >> np.uint64(32)
    slot *= np.uint64(bins)
    slot >>= np.uint64(32)
    slot = slot.view(np.int64)
    slot += np.repeat(np.arange(len(lines)) * bins, count)
    np.minimum.at(least, slot, h)
    least = least.reshape(len(lines), bins)
    # an empty bin takes what the next full one has, and how far it lies
    short = np.flatnonzero((least == _NONE).any(axis=1))
    if len(short):
        part = least[short]
        place = np.where(part == _NONE, 2 * bins, np.arange(bins))
        ahead = np.concatenate((place, place + bins), axis=1)
        ahead = np.minimum.accumulate(ahead[:, ::-1], axis=1)[:, ::-1][:, :bins]
        steps = (ahead - np.arange(bins)).astype(np.uint64)
        borrowed = np.take_along_axis(part, ahead % bins, axis=1)
        least[short] = np.where(steps > 0, _mixed(borrowed + steps), borrowed)
    key = np.zeros((len(lines), BANDS), np.uint64)
    for k in range(ROWS):
        key = _mixed(key * _POWERS[1] + least[:, k::ROWS])
    return (key + np.arange(BANDS, dtype=np.uint64) * _MUL).view(np.int64)


def _bands(batches):
    """Arrow batches of (key, id): the bands of every line, once for equal lines as long as a task remembers them."""
    import pyarrow as pa

    def out(group):
        ids = np.fromiter(group, np.int64, len(group))
        keys = band_keys(list(group.values()))
        return pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(ids, BANDS))], ["key", "id"])

    seen, held, size = set(), {}, 0
    for batch in batches:
        for text in batch.column(0):
            norms = [norm for _, _, norm in lines_of(text.as_py())]
            for i, norm in zip(line_ids(norms), norms):
                if i in seen:
                    continue
                seen.add(i)
                held[i] = norm
                size += len(norm)
                if size > STRETCH:
                    yield out(held)
                    held, size = {}, 0
            if len(seen) > REMEMBERED:
                seen.clear()
    if held:
        yield out(held)


def link_lines(lines: list[tuple[int, str]], threshold: float) -> list[tuple[int, int]]:
    """Links that join what is similar in one bucket of different lines, searching on from each line found."""
    return list(_linked([dict(lines)], threshold))


def _linked(buckets: list[dict], threshold: float):
    """Links of some buckets, {id: line}; lines that they have in common are hashed once, and joined ones not compared again."""
    norms = {i: norm for bucket in buckets for i, norm in bucket.items()}
    place = dict(zip(norms, range(len(norms))))
    sets, spread = shingle_sets(list(norms.values()))
    size = np.array([len(x) for x in sets])
    root = list(range(len(sets)))

    def top(k):
        while root[k] != k:
            root[k] = k = root[root[k]]
        return k

    def possible(x, left):
        """Those of ``left`` that may be similar to ``x`` by their sizes and their numbers in each range."""
        at = np.array(left)
        small, large = np.minimum(size[at], size[x]), np.maximum(size[at], size[x])
        both = np.minimum(spread[at], spread[x]).sum(axis=1)
        return ((small >= threshold * large) & (both >= threshold * (size[at] + size[x] - both))).tolist()

    def similar(x, y):
        a, b = sets[x], sets[y]
        small, large = min(len(a), len(b)), max(len(a), len(b))
        if small < threshold * large:
            return False
        ab = np.concatenate((a, b))
        ab.sort()
        both = int(np.count_nonzero(ab[1:] == ab[:-1]))
        return both >= threshold * (len(a) + len(b) - both)

    name = list(norms)
    for bucket in buckets:
        left = [place[i] for i in bucket]
        while len(left) > 1:
            todo, left = [left[0]], left[1:]
            while todo and left:
                x = todo.pop()
                own, rest = top(x), []
                for y, may in zip(left, possible(x, left) if len(left) > FEW else [True] * len(left)):
                    if top(y) == own:
                        todo.append(y)
                    elif may and similar(x, y):
                        yield name[x], name[y]
                        root[top(y)] = own
                        todo.append(y)
                    else:
                        rest.append(y)
                left = rest


def _compared(threshold: float):
    def run(rows):
        """Sorted by bucket; whole buckets (or pairs of blocks) are held until they fill a stretch, and hashed together."""
        now, buckets, held, size = None, [], set(), 0
        for _, p, q, key, i, norm in rows:
            if (key, p, q) != now:
                if size > STRETCH:
                    yield from _linked(buckets, threshold)
                    buckets, held, size = [], set(), 0
                now = key, p, q
                buckets.append({})
            buckets[-1][i] = norm
            if i not in held:
                held.add(i)
                size += len(norm)
        if buckets:
            yield from _linked(buckets, threshold)

    return run


def _marked(ids: DataFrame) -> bytes:
    """A bit map of ids (column w), BITS bits whatever their number: it only spares lines a shuffle."""
    at = F.col("w").bitwiseAND(BITS - 1) + 1
    maps = ids.groupBy(F.bitmap_bucket_number(at).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("m"))
    out = bytearray(BITS // 8)
    for r in maps.collect():
        out[(r["k"] - 1) * 4096 : r["k"] * 4096] = r["m"]
    return bytes(out)


def similar_links(docs: DataFrame, text_col: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """(src, dst) links that join all lines found similar, by line id."""
    ship(docs.sparkSession)
    text = docs.select(F.col(f"`{text_col}`").alias("t"))
    dealt = text.mapInArrow(_bands, "key bigint, id bigint").where("key IS NOT NULL")  # as the join below would add to one side only
    dealt = dealt.repartition("key")  # one shuffle, read by the aggregate and by the join; a task sends a line's bands once
    several = dealt.groupBy(F.col("key").alias("bucket")).agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    # an inner join: under a semi join Spark plans a second, different shuffle of the bands
    members = dealt.join(several.select("bucket").hint("shuffle_hash"), F.col("key") == F.col("bucket"))
    members = cut_lineage(members.groupBy("key", "id").agg(F.lit(1).alias("one")).drop("one"))
    buckets = members.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi"),
                                         F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("all"))
    buckets = stored(buckets.groupBy("n", "lo", "hi", "all").agg(F.min("key").alias("bucket")))
    members = cut_lineage(members.join(buckets.select("bucket", "n", "lo"), F.col("key") == F.col("bucket")).select("key", "n", "lo", "id"))
    wanted = members.select(F.col("id").alias("w")).distinct()
    marked = _marked(wanted)

    def possible(rows):
        """Lines that may be wanted; the join below drops the few that are not."""
        for (t,) in rows:
            norms = [*{n for _, _, n in lines_of(t)}]
            for i, norm in zip(line_ids(norms), norms):
                p = i & BITS - 1
                if marked[p >> 3] >> (p & 7) & 1:
                    yield i, norm

    lines = map_rows(text, possible, "lid bigint, norm string")
    lines = lines.join(wanted, F.col("lid") == F.col("w"), "left_semi").groupBy("lid").agg(F.min("norm").alias("norm"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    pairs = members.select("key", "lo", "id", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    pairs = pairs.select("key", "lo", "id", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"))
    rows = pairs.join(lines, F.col("id") == F.col("lid")).select("lo", "p", "q", "key", "id", "norm")
    # buckets of one least line, BANDS at most, have many lines in common: they meet in one task, one after another
    rows = rows.repartition("lo", "p", "q").sortWithinPartitions("lo", "p", "q", "key", "id")
    return map_rows(rows, _compared(threshold), "src bigint, dst bigint").distinct()


def _places(batches):
    """Arrow batches of (id, text_hash, line_no, start, end, lid) of every line, from such of id, text and its hash."""
    import pyarrow as pa

    def out(part, rows, found):
        at = pa.array(np.repeat(rows, [len(x) for x in found]))
        start, end, norms = zip(*(line for x in found for line in x))
        number = np.concatenate([np.arange(len(x), dtype=np.int32) for x in found])
        cols = [pa.array(number), pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(line_ids(norms), pa.int64())]
        return pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(2).take(at), *cols],
                                          ["id", "text_hash", "line_no", "start", "end", "lid"])

    for part in batches:
        rows, found, size = [], [], 0
        for k, text in enumerate(part.column(1)):
            lines = lines_of(text.as_py())
            if lines:
                rows.append(k)
                found.append(lines)
                size += lines[-1][1]
            if size > 1 << 20:
                yield out(part, rows, found)
                rows, found, size = [], [], 0
        if found:
            yield out(part, rows, found)


def line_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """(id, text_hash, line_no, start, end, keep_id, keep_line_no, kept) for each line that is not blank.

    Lines are one class if equal when normalised, or joined by links of Jaccard similarity ``threshold`` or more; the
    class is named by its earliest line by (id, text, line number), which stays. Null ids rank last. Rows that
    repeat id and text are one document and get the same answer. Null and empty texts have no lines; an empty
    table gives an empty one; other columns are not looked at. Lines are told apart by 64-bit digests.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    links = cut_lineage(similar_links(docs, text_col, threshold))
    found = connected_components(links)

    picked = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), text_hash(text_col))
    lines = stored(picked.mapInArrow(_places, f"id {kind}, text_hash bigint, line_no int, start int, end int, lid bigint"))  # numbers alone
    place = F.struct(F.isnull("id").alias("u"), F.col("id"), F.col("text_hash"), F.col("line_no"))
    # each different line's earliest place, then each class's; both combine before they shuffle
    firsts = cut_lineage(lines.groupBy("lid").agg(F.min(place).alias("first")))
    named = firsts.join(found, F.col("lid") == F.col("node"), "left").select("lid", "first", F.coalesce("component", "lid").alias("root"))
    least = named.groupBy(F.col("root").alias("r")).agg(F.min("first").alias("keep"))
    keep = named.join(least, F.col("root") == F.col("r")).select(F.col("lid").alias("l"), "keep")
    keep = stored(keep)  # a join right above an aggregate could not split a hot line
    return lines.join(keep, F.col("lid") == F.col("l")).select(
        F.col("id").alias(id_col), "text_hash", "line_no", "start", "end", F.col("keep.id").alias("keep_id"),
        F.col("keep.line_no").alias("keep_line_no"), F.col("keep").eqNullSafe(place).alias("kept"))


@query("op8_fuzzy_line_dedup")
def op8_fuzzy_line_dedup(spark, sf_dir):
    """Classes of similar lines over every line of documents."""
    return line_classes(table(spark, sf_dir, "documents")).drop("text_hash")
