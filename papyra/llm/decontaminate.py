"""Benchmark decontamination: a broadcast set of test n-grams against all training windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyra.llm.stored import free_name, stored
from papyra.sources.sizes import can_broadcast

NGRAM = 13
# A document is contaminated when at least one word in so many is hit.
HIT_SHARE = 20
# Windows are formed from runs of so many start positions, so that no row copies a whole text.
RUN = 64
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Normalised words: A-Z lower-cased, then runs of digits, letters and non-ASCII characters."""
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(WORD), F.lit(0))


def benchmark_windows(items: DataFrame, id_col: str, text_col: str, ngram: int = NGRAM) -> DataFrame:
    """``window, size, items``: the distinct windows and the ids of the items that hold each."""
    tokens = items.select(
        F.col(id_col).cast("string").alias("item"), words(F.col(text_col).cast("string")).alias("tokens")
    ).where("item is not null and size(tokens) > 0")
    tokens = tokens.select("item", "tokens", F.least(F.size("tokens"), F.lit(ngram)).alias("size"))
    starts = F.sequence(F.lit(1), F.size("tokens") - F.col("size") + 1)
    windows = tokens.select("item", "tokens", "size", F.explode(starts).alias("start")).select(
        "item", "size", F.array_join(F.slice("tokens", F.col("start"), F.col("size")), " ").alias("window")
    )
    return windows.groupBy("window", "size").agg(F.sort_array(F.collect_set("item")).alias("items"))


def decontaminate(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", ngram: int = NGRAM,
) -> DataFrame:
    """``id_col, n_words, n_hit, hit_spans, items, contaminated`` for each row of ``docs``.

    A window is ``ngram`` consecutive words of an item, or all words of a shorter item; a word of a
    document is hit where it lies in any occurrence of a window. ``hit_spans`` are the hit words as
    disjoint, increasing ``(first, last)`` word numbers, ``items`` the ids, as sorted strings, of
    items with an occurring window. Contaminated is a document of which at least one word in
    ``HIT_SHARE`` is hit.

    The benchmark's windows are a broadcast hash set when their number and bytes have been measured
    to be small, otherwise both sides are shuffled. Training windows are looked up by hash and then
    compared as text. Only hits, and one row for each document, leave a task.

    A null or empty text has no words and is clean; null ids are kept; each row that repeats an id
    gets a row. Items without id or words count nothing, and an empty benchmark hits nothing.
    """
    bench = stored(benchmark_windows(items, item_id_col, item_text_col, ngram), "bench")
    sizes = sorted(row["size"] for row in bench.select("size").distinct().collect())
    bench = bench.select(F.xxhash64("window").alias("hash"), "window", "items")
    narrow = bench.select("window", F.array_join("items", ",").alias("names"))
    if can_broadcast(narrow):
        bench = F.broadcast(bench)
    tokens = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"),
        F.coalesce(words(F.col(text_col).cast("string")), F.array().cast("array<string>")).alias("tokens"),
    )
    runs = tokens.select(
        "id", "text_hash", F.size("tokens").alias("n_words"),
        F.explode(F.transform(
            F.sequence(F.lit(0), F.greatest(F.size("tokens") - 1, F.lit(0)), F.lit(RUN)),
            lambda first: F.struct(
                first.alias("first"),
                F.slice("tokens", first + 1, F.lit(RUN + ngram - 1)).alias("tokens"),
            ),
        )).alias("run"),
    )
    windows = runs.select(
        "id", "text_hash", "n_words", F.col("run.first").alias("first"),
        F.explode(_windows(F.col("run.tokens"), sizes, F.col("run.first") == 0)).alias("at"),
    ).select(
        "id", "text_hash", "n_words", (F.col("first") + F.col("at.start")).alias("start"),
        F.col("at.size").alias("size"), F.col("at.window").alias("window"),
    ).withColumn("hash", F.when(F.col("size") > 0, F.xxhash64("window")).otherwise(F.col("text_hash")))
    looked_up = windows.join(bench, ["hash", "window"], "left").where("items is not null or size = 0")
    spans = F.collect_set(F.when(F.col("size") > 0, F.struct("start", "size")))
    found = looked_up.groupBy("id", "text_hash", "n_words").agg(
        F.count_if(F.col("size") == 0).alias("copies"), _joined(F.sort_array(spans)).alias("hit_spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    n_hit = F.aggregate("hit_spans", F.lit(0), lambda n, span: n + span["last"] - span["first"] + 1)
    each = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return found.select("*", each.alias("_")).select(
        F.col("id").alias(id_col), F.col("n_words").cast("long").alias("n_words"),
        n_hit.cast("long").alias("n_hit"), "hit_spans", "items",
        ((n_hit > 0) & (HIT_SHARE * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def _windows(tokens: Column, sizes: list[int], first_run: Column) -> Column:
    """``(start, size, window)`` for each start in a run; a document's first run adds a marker."""
    kind = "array<struct<start:int,size:int,window:string>>"
    marker = F.array(F.struct(
        F.lit(0).alias("start"), F.lit(0).alias("size"), F.lit(None).cast("string").alias("window")
    )).cast(kind)
    parts = [F.when(first_run, marker).otherwise(F.array().cast(kind))]
    for size in sizes:
        count = F.least(F.size(tokens) - (size - 1), F.lit(RUN))
        made = F.transform(F.sequence(F.lit(0), count - 1), _window(tokens, size))
        parts.append(F.when(count > 0, made).otherwise(F.array().cast(kind)))
    return F.concat(*parts)


def _window(tokens: Column, size: int) -> Callable[[Column], Column]:
    return lambda start: F.struct(
        start.alias("start"), F.lit(size).alias("size"),
        F.array_join(F.slice(tokens, start + 1, F.lit(size)), " ").alias("window"),
    )


def _joined(hits: Column) -> Column:
    """Sorted ``(start, size)`` hits as disjoint ``(first, last)`` runs of words."""
    kind = "array<struct<first:int,last:int>>"

    def add(runs: Column, hit: Column) -> Column:
        last = hit["start"] + hit["size"] - 1
        before = F.element_at(runs, -1)
        joins = (F.size(runs) > 0) & (hit["start"] <= before["last"] + 1)
        longer = F.concat(
            F.slice(runs, F.lit(1), F.size(runs) - 1),
            F.array(F.struct(before["first"].alias("first"), F.greatest(before["last"], last).alias("last"))),
        )
        return F.when(joins, longer).otherwise(
            F.concat(runs, F.array(F.struct(hit["start"].alias("first"), last.alias("last"))))
        )

    return F.aggregate(hits, F.array().cast(kind), add)


def remove_contaminated(docs: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the contaminated ones, all columns kept; rows without an id stay."""
    ids = stored(found.where("contaminated").select(id_col).distinct(), "contaminated")
    if can_broadcast(ids):
        ids = F.broadcast(ids)
    return docs.join(ids, id_col, "left_anti")


def remove_spans(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the hit words of contaminated documents cut out of ``text_col``.

    A cut document is the normalised words that were not hit, one space between them. ``id_col`` must
    tell rows apart here (a stored row number does); rows without an id are left as they are.
    """
    noted = free_name(docs, "_spans")
    spans = found.where("contaminated").select(F.col(id_col), F.col("hit_spans").alias(noted))
    tokens = F.filter(
        words(F.col(text_col)),
        lambda word, place: ~F.exists(noted, lambda s: (place >= s["first"]) & (place <= s["last"])),
    )
    cut = F.when(F.col(noted).isNull(), F.col(text_col)).otherwise(F.array_join(tokens, " "))
    return docs.join(spans, id_col, "left").withColumn(text_col, cut).select(docs.columns)
