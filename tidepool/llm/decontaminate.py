"""Benchmark decontamination: windows of benchmark words against every document, in DataFrame operations only.

A window is 10 consecutive words of a benchmark item (a shorter item is one window). A document that holds a
window of L words holds, inside it, a whole block of b = ceil(L / 2) words that starts at a multiple of b.
So only the aligned blocks of a document are hashed, a fifth of its words for L = 10, and looked up in the
broadcast hash set of the benchmark's b-word pieces; a hit says where the window would start, and its words are
compared there. Each occurrence of a window is found at just one block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import query
from .common import keep_rows, table, text_hash

WORDS = 10
#: Bytes of benchmark windows that are broadcast at most; a larger benchmark is joined by shuffles.
BROADCAST_BYTES = 64 << 20
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Beyond ASCII, what lower() may change: without such a character it lower-cases A-Z alone.
_OTHER_CASE = r"[\p{Lu}\p{Lt}\p{Nl}\p{So}\p{M}&&[^\x00-\x7F]]"


def words_of(text: Column) -> Column:
    """The words, A-Z lower-cased; none for null."""
    low = F.when(text.rlike(_OTHER_CASE), F.translate(text, _UPPER, _UPPER.lower())).otherwise(F.lower(text))
    return F.regexp_extract_all(F.coalesce(low, F.lit("")), F.lit(_WORD), 0)


def _named(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A column that is computed once a row, however often it is used (a generator is not folded into users)."""
    return df.withColumn(name, F.explode(F.array(value)))


def benchmark_windows(bench: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(win, len, items): each different window once, with the ids that have it. Null or wordless items have none."""
    w = _named(bench.select(F.col(id_col).alias("item"), F.col(text_col).alias("t")), "w", words_of(F.col("t")))
    n = F.size("w")
    starts = F.sequence(F.lit(1), F.greatest(n - WORDS, F.lit(0)) + 1)
    wins = w.where(n > 0).select("item", "w", F.explode(starts).alias("s"))
    wins = wins.select("item", F.expr(f"slice(w, s, {WORDS})").alias("win"))
    return wins.groupBy("win").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items")).select(
        "win", F.size("win").alias("len"), "items")


def _keys(wins: DataFrame) -> DataFrame:
    """(h, off, len, win, items): the b-word pieces of each window at offsets 0 to b - 1."""
    b = F.expr("div(len + 1, 2)").cast("int")
    return wins.select(F.explode(F.sequence(F.lit(0), b - 1)).alias("off"), b.alias("b"), "len", "win", "items").select(
        F.xxhash64(F.col("b"), F.expr("slice(win, off + 1, b)")).alias("h"), "off", "len", "win", "items")


def _blocks(widths: list[int]) -> Column:
    """Array of (start, hash) of the aligned blocks of each width."""
    parts = [f"""transform(CASE WHEN size(w) >= {b} THEN sequence(0, size(w) - {b}, {b}) ELSE array() END,
                 i -> named_struct('at', i, 'h', xxhash64({b}, slice(w, i + 1, {b}))))""" for b in widths]
    return F.expr(f"concat({', '.join(parts)})" if parts else "cast(array() AS array<struct<at: int, h: bigint>>)")


def _fits() -> Column:
    """The window's words stand in the document where the block says."""
    start = F.col("at") - F.col("off")
    return F.when(start >= 0, F.slice("w", F.greatest(start, F.lit(0)) + 1, F.col("len")) == F.col("win")).otherwise(False)


def scan(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text: str = "text") -> DataFrame:
    """(id, text_hash, n_words, hits, items) for each row of ``docs``.

    hits holds (first word, words) of every window that occurs, items the ids of the items it belongs to. Null
    texts have no words; an empty benchmark, or a benchmark of null texts, hits nothing; repeated rows each get
    their row; an empty table gives an empty one. Other columns are not looked at.
    """
    wins = cut_lineage(benchmark_windows(bench, item_col, item_text))
    size = wins.agg(F.sum(F.length(F.concat_ws(" ", "win")) + F.length(F.concat_ws(",", "items")) + 64)).first()[0] or 0
    lengths = [r["len"] for r in wins.select("len").distinct().collect()]  # 1 to WORDS, so ten at most
    widths = sorted({(n + 1) // 2 for n in lengths})
    keys = _keys(wins)

    base = docs.select(F.col(f"`{id_col}`").alias("id"), text_hash(text_col).alias("text_hash"),
                       F.monotonically_increasing_id().alias("row"), F.col(f"`{text_col}`").alias("t"))
    base = _named(base, "w", words_of(F.col("t"))).select("id", "text_hash", "row", "w")
    blocks = base.select("*", F.size("w").alias("n_words"), _blocks(widths).alias("blocks"))
    # one scan, one shuffle: a row that stands for the document itself, and one for each hit
    at = F.explode(F.concat(F.array(F.struct(F.lit(-1).alias("at"), F.lit(None).cast("bigint").alias("h"))), "blocks"))
    if size * max(widths, default=1) <= BROADCAST_BYTES:
        each = blocks.select("id", "text_hash", "row", "n_words", "w", at.alias("b")).select(
            "id", "text_hash", "row", "n_words", "w", "b.at", "b.h")
        met = each.withColumnRenamed("h", "bh").join(F.broadcast(keys), (F.col("bh") == F.col("h")) & _fits(), "left")
        met = met.where("at < 0 OR len IS NOT NULL")
    else:
        met = _by_shuffle(cut_lineage(blocks), at, keys)
    hit = F.when(F.col("len").isNotNull(), F.struct((F.col("at") - F.col("off")).alias("at"), "len"))
    return met.groupBy("row").agg(
        F.first("id").alias(id_col), F.first("text_hash").alias("text_hash"), F.first("n_words").cast("bigint").alias("n_words"),
        F.collect_set(hit).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    ).drop("row")


def _by_shuffle(blocks: DataFrame, at: Column, keys: DataFrame) -> DataFrame:
    """The same rows for a benchmark too large to broadcast: hashes meet first, words only where they did."""
    each = blocks.select("row", at.alias("b")).select("row", "b.at", F.col("b.h").alias("bh"))
    met = each.where("at >= 0").join(keys, F.col("bh") == F.col("h")).select("row", "at", "off", "len", "win", "items")
    words = blocks.select(F.col("row").alias("r"), "w")
    found = met.join(words, F.col("row") == F.col("r")).where(_fits()).select("row", "at", "off", "len", "items")
    own = blocks.select("id", "text_hash", "row", "n_words", F.lit(-1).alias("at"))
    return own.unionByName(found, allowMissingColumns=True)


def hit_words() -> Column:
    """Positions of the words inside any hit."""
    return F.expr("array_distinct(flatten(transform(hits, x -> sequence(x.at, x.at + x.len - 1))))")


def report(found: DataFrame) -> DataFrame:
    """The figures of a scan: n_hit words, n_items, items_sha256, contaminated."""
    return found.withColumn("n_hit", F.size(hit_words()).cast("bigint")).select(
        *(c for c in found.columns if c not in ("hits", "items")), "n_hit",
        F.size("items").cast("bigint").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold any window; repeated rows become one."""
    clean = scan(docs, bench, id_col, text_col).where(F.size("hits") == 0)
    return keep_rows(docs, clean, id_col, text_col)


def cut_spans(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the words inside windows taken out of the text, and what stands between them and the next word."""
    spoiled = scan(docs, bench, id_col, text_col).where(F.size("hits") > 0)
    spoiled = spoiled.select(F.col(id_col).alias("_tk_id"), F.col("text_hash").alias("_tk_hash"), hit_words().alias("_tp_out")).distinct()
    left = docs.withColumns({"_tp_id": F.col(f"`{id_col}`"), "_tp_hash": text_hash(text_col)})
    on = F.col("_tp_id").eqNullSafe(F.col("_tk_id")) & F.col("_tp_hash").eqNullSafe(F.col("_tk_hash"))
    word, gap = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
    t = F.col(f"`{text_col}`")
    units = F.regexp_extract_all(t, F.lit(f"{word}{gap}"), 0)
    kept = F.filter(F.transform(units, lambda u, i: F.when(~F.array_contains("_tp_out", i), u)), lambda u: u.isNotNull())
    cut = F.concat(F.regexp_extract(t, f"^{gap}", 0), F.array_join(kept, ""))
    out = left.join(spoiled, on, "left").withColumn(text_col, F.when(F.col("_tp_out").isNull(), t).otherwise(cut))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))


SQL = r"""
WITH bw AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS l,
               array_to_string(w[s:s + 9], ' ') AS g
        FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s FROM bw WHERE len(w) > 0)),
dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
pos AS (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS p FROM dw),
dg AS (SELECT doc_id, p, l, array_to_string(w[p:p + l - 1], ' ') AS g
       FROM pos, (SELECT DISTINCT l FROM win) WHERE p + l - 1 <= len(w)),
hit AS (SELECT dg.doc_id, dg.p, dg.l, win.item_id FROM dg JOIN win ON dg.g = win.g AND dg.l = win.l),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(generate_series(p, p + l - 1)) AS q FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(i, ',' ORDER BY i)) AS h
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, len(dw.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words ON dw.doc_id = words.doc_id LEFT JOIN items ON dw.doc_id = items.doc_id
"""


@query("op4_benchmark_decontamination", SQL)
def op4_benchmark_decontamination(spark, sf_dir):
    """Every whole text of documents against every window of benchmark."""
    found = scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return report(found).drop("text_hash")
