"""Near-duplicates: SetSketch registers in bands, joint likelihood estimates, exact confirmation."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from papyra.llm.components import components
from papyra.llm.setsketch import (
    BAND_ROWS, BANDS, REGISTERS, band_keys, estimated_similarity, likely_similarity, sketch,
)
from papyra.llm.stored import stored
from papyra.llm.words import blocks, hash_words, mix, random_words, shingle_hashes
from papyra.sources.sizes import can_broadcast

THRESHOLD_PERCENT = 75
# A pair is confirmed on its sets unless its estimate is this many standard errors too low.
MARGIN = 4.0
LEAST_ESTIMATE = THRESHOLD_PERCENT / 100 - MARGIN * math.sqrt(0.75 * 0.25 / REGISTERS)
# Shingles, and rows, in a part of a bucket; two parts are compared with each other in one group.
BLOCK_ELEMENTS, BLOCK_ROWS = 300_000, 500
# Ids go through pandas as text, since it keeps no integers beside nulls.
_NOTE = "id string, key_a long, key_b long, n long, registers binary"
_KEYS = random_words(2, 11)


def _sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        ids = batch["id"].to_numpy()
        for first, raw in blocks(list(batch["text"])):
            words, offsets = hash_words(raw)
            rows = []
            for number in range(len(raw)):
                own = words[offsets[number] : offsets[number + 1]]
                place = np.arange(1, len(own) + 1, dtype=np.uint64)
                keys = [
                    int(np.bitwise_xor.reduce(mix(own + key * place), initial=0).astype(np.int64))
                    for key in _KEYS
                ]
                elements = shingle_hashes(own)
                rows.append((ids[first + number], *keys, len(elements), sketch(elements)))
            yield pd.DataFrame(rows, columns=["id", "key_a", "key_b", "n", "registers"])


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        ids = batch["id"].to_numpy()
        for first, raw in blocks(list(batch["text"])):
            words, offsets = hash_words(raw)
            sets = [
                shingle_hashes(words[offsets[i] : offsets[i + 1]]).view(np.int64) for i in range(len(raw))
            ]
            yield pd.DataFrame({"id": ids[first : first + len(raw)], "elements": sets})


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` for each row of ``docs``.

    Texts are linked when their sets of five-word shingles have a Jaccard similarity of 0.75 or
    more; ``component_id`` is the least id reachable over links, and the row with that id is kept.

    Equal texts fall into one class, named by its least id, before anything else, so copies are
    never paired. Classes that share a band of registers are candidates. In each bucket all members
    are compared with a leader; where that leaves a bucket with members of several
    components, each member outside its leader's component is compared with all members of other
    components, in blocks. The leader is the member that shares most buckets, as an original does
    among its edited copies. Hence no link between bucket mates is missed, while a bucket of copies of one text
    costs a comparison each. A pair is confirmed on its full sets unless the likelihood estimate
    from its registers is far below the threshold.

    Null and empty texts and texts without words have no shingles and stand alone. A row without
    an id has no component and is kept. Rows that repeat an id are the same document: all of them
    stay or go together, and their texts should be equal. Ids must be whole numbers; any others are
    an error, and a stored row number can stand for them.
    """
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        raise ValueError("near-duplicates are named by whole numbers; number the rows of a table with other ids")
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    named_texts = given.withColumn("id", F.col("id").cast("string"))
    sketches = named_texts.mapInPandas(_sketches, _NOTE).withColumn("id", F.col("id").cast("long"))
    notes = stored(sketches, "sketches")
    named = notes.where("n > 0 and id is not null")
    classes = stored(named.groupBy("key_a", "key_b").agg(F.min("id").alias("rep")), "classes")
    reps = stored(
        named.join(classes.select(F.col("rep").alias("id")), "id", "left_semi")
        .dropDuplicates(["id"]).select("id", "n", "registers"),
        "reps",
    )
    found = _found(given, reps)
    merged = classes.join(
        found.withColumnRenamed("id", "rep"), "rep", "left"
    ).select("key_a", "key_b", F.coalesce("component", "rep").alias("component"))
    alone = notes.where("n = 0 or id is null").select("id", "n", F.col("id").alias("component"))
    together = named.join(merged, ["key_a", "key_b"]).select("id", "n", "component")
    return together.unionByName(alone).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def _found(given: DataFrame, reps: DataFrame) -> DataFrame:
    """``id, component`` of the class representatives that are linked with others."""
    entries = reps.select("id", F.posexplode(band_keys(F.col("registers"))).alias("band", "bucket"))
    sizes = entries.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = stored(entries.join(sizes, "bucket"), "members")
    central = members.groupBy("id").agg(F.sum("size").alias("mates"))
    leaders = members.join(central, "id").groupBy("bucket").agg(
        F.max(F.struct("mates", (-F.col("id")).alias("no"))).alias("most")
    )
    buckets = stored(
        members.join(leaders, "bucket").select("bucket", "band", "id", (-F.col("most.no")).alias("leader")),
        "buckets",
    )
    stars = buckets.where("id <> leader").select(
        F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")
    )
    likely = stored(_likely(stars.distinct(), reps), "likely")
    needed = likely.select(F.col("a").alias("id")).union(likely.select("b"))
    links = _confirmed(likely, _sets_of(given, needed))
    label = stored(components(links), "labels")
    more = _rest(given, reps, buckets, label)
    return label if more.isEmpty() else components(links.unionByName(more))


def _rest(given: DataFrame, reps: DataFrame, buckets: DataFrame, label: DataFrame) -> DataFrame:
    """Links between bucket mates of different components, of which none is the leader.

    In a bucket with several components, members outside its leader's component are queries
    against all members. Both sides are dealt into parts of about ``BLOCK_ELEMENTS`` shingles
    and ``BLOCK_ROWS`` rows at most; pairs are compared inside a block, and only links leave it.
    """
    lead = label.select(F.col("id").alias("leader"), F.col("component").alias("leading"))
    placed = (
        buckets.join(label, "id", "left").join(lead, "leader", "left")
        .join(reps.select("id", "n"), "id")
        .select(
            "bucket", "band", "id", "n", F.coalesce("component", "id").alias("component"),
            (F.col("id") == F.col("leader")).alias("leads"),
            (F.coalesce("component", "id") != F.coalesce("leading", "leader")).alias("outside"),
        )
    )
    placed = stored(placed, "placed")
    several = placed.groupBy("bucket").agg(
        F.count_if(F.col("outside")).alias("queries"), F.count("*").alias("mates"),
        F.ceil(F.greatest(F.sum("n") / BLOCK_ELEMENTS, F.count("*") / BLOCK_ROWS)).cast("int").alias("chunks"),
    ).where("queries > 0 and mates > 2").select("bucket", "chunks")
    placed = placed.join(several, "bucket").where("not leads").withColumn(
        "chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    )
    every = F.sequence(F.lit(0), F.col("chunks") - 1)
    asked = placed.where("outside").select("bucket", F.col("chunk").alias("of")).distinct()
    queries = placed.where("outside").select(
        "bucket", "band", "id", "component", F.lit(True).alias("query"), F.col("chunk").alias("of"), F.explode(every).alias("against")
    )
    targets = placed.join(asked, "bucket").select(
        "bucket", "band", "id", "component", F.lit(False).alias("query"), "of", F.col("chunk").alias("against")
    )
    rows = stored(queries.unionByName(targets), "blocks")
    sets = _sets_of(given, rows.select("id"))
    full = rows.join(sets, "id").join(reps.select("id", "registers"), "id")
    found = full.groupBy("bucket", "of", "against").applyInPandas(_block_links, "a long, b long")
    return stored(found.distinct(), "links")


def _block_links(block: pd.DataFrame) -> pd.DataFrame:
    """Links between the queries and the other rows of one block, each pair in its first band."""
    queries, targets = block[block["query"]], block[~block["query"]]
    ids, parts = targets["id"].to_numpy(), targets["component"].to_numpy()
    is_query = np.isin(ids, queries["id"].to_numpy())
    sets = list(targets["elements"])
    sizes = np.array([len(x) for x in sets], dtype=np.float64)
    registers = np.frombuffer(b"".join(targets["registers"]), np.uint8).reshape(len(ids), REGISTERS)
    band = block["band"].iloc[0]
    links = []
    for own, part, mine, raw in zip(
        queries["id"], queries["component"], queries["elements"], queries["registers"]
    ):
        other = (parts != part) & ~(is_query & (ids < own))
        other &= 100 * np.minimum(sizes, len(mine)) >= THRESHOLD_PERCENT * np.maximum(sizes, len(mine))
        chosen = np.flatnonzero(other)
        if not len(chosen):
            continue
        row = np.frombuffer(raw, np.uint8)
        shared = (registers[chosen] == row).reshape(-1, BANDS, BAND_ROWS).all(axis=2)
        chosen = chosen[shared.argmax(axis=1) == band]
        larger, smaller = (registers[chosen] > row).sum(axis=1), (registers[chosen] < row).sum(axis=1)
        guess = likely_similarity(
            larger, REGISTERS - larger - smaller, smaller, sizes[chosen], np.full(len(chosen), float(len(mine)))
        )
        for place in chosen[guess >= LEAST_ESTIMATE]:
            both = len(np.intersect1d(mine, sets[place], assume_unique=True))
            if 100 * both >= THRESHOLD_PERCENT * (len(mine) + len(sets[place]) - both):
                links.append((min(own, ids[place]), max(own, ids[place])))
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _likely(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs whose estimated similarity does not rule out a link."""
    left = reps.select(F.col("id").alias("a"), F.col("registers").alias("ra"), F.col("n").alias("na"))
    right = reps.select(F.col("id").alias("b"), F.col("registers").alias("rb"), F.col("n").alias("nb"))
    possible = (100 * F.least("na", "nb")) >= THRESHOLD_PERCENT * F.greatest("na", "nb")
    return (
        pairs.join(left, "a").join(right, "b").where(possible)
        .where(estimated_similarity(F.col("ra"), F.col("rb"), F.col("na"), F.col("nb")) >= LEAST_ESTIMATE)
        .select("a", "b")
    )


def _sets_of(given: DataFrame, ids: DataFrame) -> DataFrame:
    """The full shingle sets of ``ids``, from one more pass over the texts."""
    needed = stored(ids.distinct(), "needed")
    if can_broadcast(needed):
        needed = F.broadcast(needed)
    texts = given.join(needed, "id", "left_semi").mapInPandas(_sets, "id long, elements array<long>")
    return stored(texts.dropDuplicates(["id"]), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    left = sets.select(F.col("id").alias("a"), F.col("elements").alias("ea"))
    right = sets.select(F.col("id").alias("b"), F.col("elements").alias("eb"))
    both = F.size(F.array_intersect("ea", "eb"))
    linked = 100 * both >= THRESHOLD_PERCENT * (F.size("ea") + F.size("eb") - both)
    return stored(pairs.join(left, "a").join(right, "b").where(linked).select("a", "b"), "confirmed")
