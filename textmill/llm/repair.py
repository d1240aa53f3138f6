"""Conversation structure repair: the cheapest edits that make the roles of a conversation `(s?(ua)+)?`.

A conversation is the sequence of its rows by turn (nulls first; rows of one turn by role, then text). Each row has at most one
fault, the first of: blank (no character outside blank, tab, line feed, vertical tab, form feed and carriage return), duplicate
(the same role and text stood earlier in the conversation), truncated (its last such character is not one of `.!?`).

Edits, with their costs: Keep 0, Rerole to user or assistant 2, Delete 3 (the only edit of a blank or duplicate row), Insert an
empty user or assistant row anywhere 2; a truncated row that is not deleted adds 1. Among the cheapest edit sequences whose
output roles read `(s?(ua)+)?` by their initials, the audit (edit initials in order, D I K R) that is least in ASCII is taken.

Method: one integer-minimum DP over the rows of a conversation with states (empty, after s, after u, after a). A path's weight is
one Python integer: the cost in the high digits, and the audit in base-8 digits below them, one fixed position for each edit
(D=1 I=2 K=3 R=4) and zeros after its end. Integer order is then (cost, audit) order, and the audit is read back from the
digits of the least weight, so the DP keeps no back pointers. Two paths that meet in one state after the same rows and have
equal cost never stand as prefix and extension (the extension would be inserts, which cost), so the least weight of each state
is all the DP needs. The width is 3n + 3 digits for n rows: a run of more than two inserts is never cheapest.

Scale: damage, faults, gaps and illegal pairs are column expressions and windows; the DP streams through partitions sorted by
conversation, holding the role initials and faults of one conversation (not its texts) and four weights (O(n) digits each, so O(n^2) digit work for a conversation of n rows), and the hash
of the repaired text is fed line by line; no conversation is gathered into one value.

Cases: a null role or text is read as one space (so a null text is blank); a null turn sorts first; null conv_id is a
conversation of its own; repeated rows are separate rows (the later one is a duplicate); a conversation left with no rows, or
whose rows are all deleted, has zero counts and cost, an empty audit and the SHA-256 of the empty string; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: digits of an edit in the weight; their ASCII order is the order of the letters
CODES = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTERS = {code: letter for letter, code in CODES.items()}
COST = {"K": 0, "R": 2, "D": 3, "I": 2}
#: states of the output: 0 nothing yet, 1 after system, 2 after user, 3 after assistant; 0 and 3 may end
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ENDS = (0, 3)
BLANKS = r"[\x20\x09-\x0D]"
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def _conv_key(conv_id: Column) -> Column:
    """A conversation as a string without nulls: 'n' for a null id, else 'v' and the id."""
    return F.when(conv_id.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), conv_id.cast("string")))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after damage by crc32('conv_id:turn') % 20 (nulls as one space): 0 dropped, 1 text emptied, 2 `.!?` removed,
    3 repeated (same turn), 4 role set to user."""
    space = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)
    )
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("_damage"),
    ).where(F.col("_damage") != 0)
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("_damage") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("_damage") == 1, F.lit(""))
        .when(F.col("_damage") == 2, F.regexp_replace("text", r"[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.when(F.col("_damage") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def faults(rows: DataFrame) -> DataFrame:
    """Each row with its place `pos` in its conversation (from 0), role initial, first fault and whether the pair with the
    row before it is illegal (initials not su, ua or au)."""
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    conv = Window.partitionBy("conv_key")
    placed = rows.withColumn("conv_key", _conv_key(F.col("conv_id"))).withColumn(
        "pos", F.row_number().over(conv.orderBy(*order)) - 1
    )
    seen = F.row_number().over(Window.partitionBy("conv_key", "role", "text").orderBy("pos")) > 1
    initial = F.substring("role", 1, 1)
    last_mark = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit("blank"))
        .when(seen, F.lit("duplicate"))
        .when(~last_mark.isin(".", "!", "?"), F.lit("truncated"))
    )
    pair = F.concat(F.lag(initial).over(conv.orderBy("pos")), initial)
    return placed.select(
        "conv_key",
        "conv_id",
        "turn",
        "role",
        "text",
        "pos",
        initial.alias("initial"),
        fault.alias("fault"),
        (pair.isNotNull() & ~pair.isin("su", "ua", "au")).alias("illegal"),
    )


def _relax(best: dict, state: int, weight: int, used: int) -> bool:
    if state not in best or weight < best[state][0]:
        best[state] = (weight, used)
        return True
    return False


def _inserts(best: dict, width: int) -> None:
    """Close a layer under inserts of empty user or assistant rows."""
    changed = True
    while changed:
        changed = False
        for state, (weight, used) in list(best.items()):
            for role in "ua":
                after = MOVES.get((state, role))
                if after is not None:
                    step = (COST["I"] << 3 * width) + (CODES["I"] << 3 * (width - 1 - used))
                    changed |= _relax(best, after, weight + step, used + 1)


def cheapest(rows: list[tuple[str, str | None]]) -> tuple[int, str]:
    """Least cost and audit for a conversation given as (role initial, fault) in order."""
    width = 3 * len(rows) + 3
    best: dict[int, tuple[int, int]] = {0: (0, 0)}
    _inserts(best, width)
    for initial, fault in rows:
        extra = 1 if fault == "truncated" else 0
        after_rows: dict[int, tuple[int, int]] = {}
        for state, (weight, used) in best.items():
            shift = 3 * (width - 1 - used)
            _relax(after_rows, state, weight + (COST["D"] << 3 * width) + (CODES["D"] << shift), used + 1)
            if fault in ("blank", "duplicate"):
                continue
            kept = MOVES.get((state, initial))
            if kept is not None:
                _relax(after_rows, kept, weight + (extra << 3 * width) + (CODES["K"] << shift), used + 1)
            for role in "ua":
                moved = MOVES.get((state, role))
                if role != initial and moved is not None:
                    step = ((COST["R"] + extra) << 3 * width) + (CODES["R"] << shift)
                    _relax(after_rows, moved, weight + step, used + 1)
        best = after_rows
        _inserts(best, width)
    weight = min(best[s][0] for s in ENDS if s in best)
    low = weight & ((1 << 3 * width) - 1)
    letters = []
    for place in range(width):
        code = (low >> 3 * (width - 1 - place)) & 7
        if code == 0:
            break
        letters.append(LETTERS[code])
    return weight >> 3 * width, "".join(letters)


def _audits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by conversation and place in, one (conv_key, cost, audit) per conversation out."""
    current, rows = None, []
    for batch in batches:
        out = []
        for key, initial, fault in zip(batch["conv_key"], batch["initial"], batch["fault"]):
            if key != current:
                if current is not None:
                    out.append((current, *cheapest(rows)))
                current, rows = key, []
            rows.append((initial, fault))
        yield pd.DataFrame(out, columns=["conv_key", "cost", "audit"])
    if current is not None:
        yield pd.DataFrame([(current, *cheapest(rows))], columns=["conv_key", "cost", "audit"])


def _hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines sorted by conversation and place in, one (conv_key, SHA-256 of the lines joined by line feeds) out."""
    current, digest = None, None
    for batch in batches:
        out = []
        for key, line in zip(batch["conv_key"], batch["line"]):
            if key != current:
                if current is not None:
                    out.append((current, digest.hexdigest()))
                current, digest = key, hashlib.sha256()
                digest.update(line.encode("utf-8", "surrogatepass"))
            else:
                digest.update(("\n" + line).encode("utf-8", "surrogatepass"))
        yield pd.DataFrame(out, columns=["conv_key", "repaired_sha256"])
    if current is not None:
        yield pd.DataFrame([(current, digest.hexdigest())], columns=["conv_key", "repaired_sha256"])


def repaired(conversations: DataFrame) -> DataFrame:
    """One row per conv_id of the input: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    rows = faults(damaged(conversations))
    spark = conversations.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by_conv = rows.select("conv_key", "pos", "initial", "fault").repartition(parts, "conv_key").sortWithinPartitions(
        "conv_key", "pos"
    )
    audits = by_conv.mapInPandas(_audits, "conv_key string, cost long, audit string")

    letters = audits.select("conv_key", F.posexplode(F.split("audit", "")).alias("out_pos", "letter")).where(
        F.col("letter") != ""
    )
    conv = Window.partitionBy("conv_key").orderBy("out_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    letters = letters.withColumn("pos", F.sum(F.when(F.col("letter") != "I", 1).otherwise(0)).over(conv) - 1).withColumn(
        "line_no", F.sum(F.when(F.col("letter") != "D", 1).otherwise(0)).over(conv) - 1
    )
    lines = letters.where(F.col("letter") != "D").join(
        rows.select("conv_key", "pos", "role", "text", "initial"), ["conv_key", "pos"], "left"
    )
    opens_with_system = F.max(
        F.when((F.col("line_no") == 0) & (F.col("letter") == "K") & (F.col("initial") == "s"), 1).otherwise(0)
    ).over(Window.partitionBy("conv_key"))
    turn_no = F.col("line_no") - opens_with_system
    role = F.when(F.col("letter") == "K", F.col("role")).when(turn_no % 2 == 0, F.lit("user")).otherwise(F.lit("assistant"))
    text = F.when(F.col("letter") == "I", F.lit("")).otherwise(F.col("text"))
    hashed = (
        lines.select("conv_key", "line_no", F.concat(role, F.lit(":"), text).alias("line"))
        .repartition(parts, "conv_key")
        .sortWithinPartitions("conv_key", "line_no")
        .mapInPandas(_hashes, "conv_key string, repaired_sha256 string")
    )

    counts = rows.groupBy("conv_key").agg(
        F.sum((F.col("fault") == "blank").cast("long")).alias("blank"),
        F.sum((F.col("fault") == "duplicate").cast("long")).alias("duplicate"),
        F.sum((F.col("fault") == "truncated").cast("long")).alias("truncated"),
        F.sum(F.col("illegal").cast("long")).alias("illegal"),
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long").alias("gaps"),
    )
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().withColumn(
        "conv_key", _conv_key(F.col("conv_id"))
    )
    zero = F.lit(0).cast("long")
    return (
        every.join(counts, "conv_key", "left")
        .join(audits, "conv_key", "left")
        .join(hashed, "conv_key", "left")
        .select(
            "conv_id",
            F.coalesce("gaps", zero).alias("gaps"),
            F.coalesce("blank", zero).alias("blank"),
            F.coalesce("duplicate", zero).alias("duplicate"),
            F.coalesce("truncated", zero).alias("truncated"),
            F.coalesce("illegal", zero).alias("illegal"),
            F.coalesce("cost", zero).alias("cost"),
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"),
        )
    )
