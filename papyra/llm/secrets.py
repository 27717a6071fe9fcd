"""Secret scan: patterns inside the row, then ownership counted over the whole corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyra.llm.stored import free_name, numbered, stored
from papyra.sources.sizes import can_broadcast

# Base kinds in their order: pattern, group of the value, least length of the value.
BASE_KINDS = {
    "assign": (
        r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12,
    ),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
}
# What the method adds: tokens of published forms, and long mixed strings if one owner has them.
ADDED_KINDS = {
    "known": (r"gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{20,}|eyJ[A-Za-z0-9_-]{10,}[.]eyJ[A-Za-z0-9_-]{10,}[.][A-Za-z0-9_-]{10,}", 0, 24),
    "mixed": (r"[A-Za-z0-9+/_-]{24,}", 0, 24),
}
KINDS = BASE_KINDS | ADDED_KINDS
# Quick tests that hold for every text with a span of the kind.
_HINTS = {kind: pattern for kind, (pattern, _, _) in KINDS.items()} | {
    "assign": KINDS["assign"][0].replace("=-]+)", "=-]{12})"),
    "access": r"AKIA[A-Z0-9]{14}", "hex": "[0-9a-f]{16}",
}
# A value seen with so many owners is a copied example; one seen with fewer is theirs.
COPIED_OWNERS = 3
# A live-looking value has a digit and so many different characters.
LIVE_CHARACTERS = 6
_SPAN = "array<struct<kind:int,start:int,stop:int,value:string>>"


def _spans(text: Column, number: int, kind: str) -> Column:
    """All spans of one kind: what lies between matches and the matches themselves alternate."""
    pattern, group, least = KINDS[kind]
    found = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )
    found = F.filter(found, lambda one: one["whole"].isNotNull())
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))

    def add(state: Column, one: Column) -> Column:
        start = state["at"] + F.length(one["gap"])
        stop = start + F.length(one["whole"])
        span = F.struct(
            F.lit(number).alias("kind"), start.alias("start"), stop.alias("stop"), one["value"].alias("value")
        )
        fits = F.length(one["value"]) >= least
        if kind == "mixed":
            fits &= one["value"].rlike("[0-9]") & one["value"].rlike("[a-z]") & one["value"].rlike("[A-Z]")
        spans = F.when(fits, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(stop.alias("at"), spans.alias("spans"))

    return F.when(text.rlike(_HINTS[kind]), F.aggregate(found, zero, add)["spans"]).otherwise(
        F.array().cast(_SPAN)
    )


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
    repository_col: str = "doc_id", row_col: str | None = None,
) -> DataFrame:
    """``row, id_col, spans`` for each row of ``docs``.

    ``spans`` is an array of ``(start, stop, kind, value_hash, repositories, owners, live)`` in
    order of start, then kind: code points, end exclusive. The base kinds are always kept. Every
    value found is hashed and counted over the corpus by distinct owners and repositories (a
    repository belongs to its owner): a value with ``COPIED_OWNERS`` owners or more is a widely
    copied example, any other that has a digit and ``LIVE_CHARACTERS`` different characters is
    live-looking. Long mixed strings count only if they are live-looking and overlap no other span.

    Null texts are empty; rows with null or repeated ids are scanned each for itself; a null owner
    is an owner, a null repository a repository. ``row`` numbers the rows of this result; it is
    ``row_col``, where that holds a number of its own for each row of ``docs``.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = F.concat(*[_spans(F.col("_text"), i, kind) for i, kind in enumerate(BASE_KINDS)])
    known = _spans(F.col("_text"), len(BASE_KINDS), "known")
    mixed = _spans(F.col("_text"), len(BASE_KINDS) + 1, "mixed")
    given = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col(repository_col).cast("string"), F.lit("")).alias("repository"), text.alias("_text"),
        (F.lit(None).cast("long") if row_col is None else F.col(row_col)).alias("row"),
    )
    free = lambda own, others: F.filter(
        own, lambda a: ~F.exists(others, lambda b: (a["start"] < b["stop"]) & (b["start"] < a["stop"]))
    )
    notes = (
        given.select("row", "id", "owner", "repository", base.alias("base"), known.alias("known"), mixed.alias("mixed"))
        .select("row", "id", "owner", "repository", F.concat("base", free("known", "base")).alias("sure"), "mixed")
        .select("row", "id", "owner", "repository", F.concat("sure", free("mixed", "sure")).alias("spans"))
    )
    if row_col is None:
        notes = notes.withColumn("row", F.monotonically_increasing_id())
    notes = stored(notes, "secrets")
    single = notes.where(F.size("spans") > 0).select(
        "row", "owner", "repository", F.inline("spans")
    ).withColumn("value_hash", F.sha2("value", 256))
    owned = single.select("value_hash", "owner", "repository").distinct()
    owned = owned.groupBy("value_hash", "owner").agg(F.count("*").alias("repositories"))
    owned = owned.groupBy("value_hash").agg(
        F.sum("repositories").alias("repositories"), F.count("*").alias("owners")
    )
    live = (
        (F.col("owners") < COPIED_OWNERS) & F.col("value").rlike("[0-9]")
        & (F.size(F.array_distinct(F.split("value", ""))) >= LIVE_CHARACTERS)
    )
    names = F.array(*map(F.lit, KINDS))
    judged = (
        single.join(owned, "value_hash").withColumn("live", live)
        .where(F.col("live") | (F.col("kind") != len(KINDS) - 1))
        .groupBy("row").agg(F.sort_array(F.collect_list(
            F.struct("start", "kind", "stop", "value_hash", "repositories", "owners", "live")
        )).alias("found"))
    )
    spans = F.transform(F.coalesce("found", F.array()), lambda s: F.struct(
        s["start"].alias("start"), s["stop"].alias("stop"), F.get(names, s["kind"]).alias("kind"),
        s["value_hash"].alias("value_hash"), s["repositories"].alias("repositories"),
        s["owners"].alias("owners"), s["live"].alias("live"),
    ))
    return notes.select("row", "id").join(judged, "row", "left").select(
        "row", F.col("id").alias(id_col), spans.alias("spans")
    )


def span_names(spans: Column, kinds: list[str] | None = None) -> Column:
    """``kind:start:stop`` of the spans, or of those of some kinds, joined with commas."""
    chosen = spans if kinds is None else F.filter(spans, lambda s: s["kind"].isin(kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def scan_and_redact(docs: DataFrame, text_col: str = "text", **columns: str) -> DataFrame:
    """``docs`` with the spans of a scan (given ``columns``) replaced, each row for itself.

    Rows are numbered and stored first, so that rows with null or repeated ids meet their own spans.
    """
    row = free_name(docs, "_row")
    rows = numbered(docs, row)
    scanned = scan(rows, text_col=text_col, row_col=row, **columns)
    return redact(rows, scanned, text_col=text_col, row_col=row).select(docs.columns)


def redact(
    docs: DataFrame, scanned: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None
) -> DataFrame:
    """``docs`` with every span replaced: ``<secret>`` if live-looking, else ``<example>``.

    Overlapping spans are replaced as one, which is a secret if one of them is. Rows find their
    spans by ``row_col``, the one given to ``scan``. Without it they do by id, which must then be
    unique, and rows without an id are left as they are.
    """
    noted, merged_name = free_name(docs, "_spans"), free_name(docs, "_merged")
    if row_col is not None:
        id_col, scanned = row_col, scanned.select(F.col("row").alias(row_col), "spans")
    found = scanned.where((F.size("spans") > 0) & F.col(id_col).isNotNull()).select(
        id_col, F.array_join(F.transform("spans", lambda s: F.concat_ws(
            ":", s["start"], s["stop"], F.when(s["live"], 1).otherwise(0)
        )), ",").alias(noted),
    )
    found = stored(found, "spans")
    if can_broadcast(found):
        found = F.broadcast(found)
    kind = "array<struct<start:int,stop:int,live:int>>"
    parsed = F.transform(F.split(noted, ","), lambda s: F.struct(
        F.split(s, ":")[0].cast("int").alias("start"), F.split(s, ":")[1].cast("int").alias("stop"),
        F.split(s, ":")[2].cast("int").alias("live"),
    ))

    def join(done: Column, one: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        wider = F.struct(
            last["start"].alias("start"), F.greatest(last["stop"], one["stop"]).alias("stop"),
            F.greatest(last["live"], one["live"]).alias("live"),
        )
        return F.when(
            F.coalesce(one["start"] < last["stop"], F.lit(False)),
            F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(wider)),
        ).otherwise(F.concat(done, F.array(one)))

    merged = F.aggregate(parsed, F.array().cast(kind), join)
    text = F.col(text_col)
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def cut(done: Column, one: Column) -> Column:
        mark = F.when(one["live"] == 1, "<secret>").otherwise("<example>")
        return F.struct(
            F.concat(done["out"], F.substring(text, done["at"] + 1, one["start"] - done["at"]), mark).alias("out"),
            one["stop"].alias("at"),
        )

    clean = F.aggregate(
        F.col(merged_name), state, cut,
        lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))),
    )
    joined = docs.join(found, id_col, "left").withColumn(merged_name, F.when(F.col(noted).isNotNull(), merged))
    return joined.withColumn(
        text_col, F.when(F.col(merged_name).isNull(), text).otherwise(clean)
    ).select(docs.columns)
