"""Operator 13: repair of conversation structure by an integer-minimum DAG.

Turns are kept, reroled, deleted, or inserted so that the role initials of a
conversation read ``(s?(ua)+)?`` at the least cost; of the cheapest edits the one
whose audit letters (D, I, K, R in order) come first in ASCII order counts.

The states of the pattern (nothing yet, after s, after u, after a) and the turns make
a DAG whose edges are edits.  The weight of a path is one integer: its high digits
are the cost, its low digits the audit letters, the first letter in the highest of a
fixed number of places, the end padded with zeros.  So the smaller of two integers is
the cheaper path and, at equal cost, the one whose letters come first; the least
weight from each node to the end follows from the next turn's by plain minima, and
prepending an edge moves the letters by one place.

1. Equal turns of a conversation are counted together, without their texts (a digest
   stands for them), and read in order, one conversation after another.
2. The DP leaves a decision for each turn and the figures of the conversation.
3. Decisions and texts meet in the order of the turns; the repaired turns stream out,
   no conversation's texts are held.

Step 2 holds the digests, one number a turn and state, and four integers of 9 bits a
turn of one conversation, and its time grows with the square of a conversation's turns
(of 9/64 words each); step 3 holds one turn.

Defined results: NULL role or text count as one space (the role fits nothing, the text
is blank); an empty role fits nothing; turns are read by turn (NULL first), then role
and the MD5 of the text; of equal turns all but the first are duplicates; NULL ids are
one conversation; a conversation without turns has zeros, no audit and the digest of
the empty text; an empty table gives an empty table.  Only conv_id, turn, role and text
are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm.common import on_executors, table
from parcelflow.session import stored

KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 2, 3, 2, 1
#: Audit letters by their digit; 0 pads the end.
LETTERS = " DIKR"
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
DIGIT_BITS = 3
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: The state after a kept turn, by initial; others fit nothing.
NEXT = {"s": (AFTER_S, None, None, None), "u": (AFTER_U, AFTER_U, None, AFTER_U),
        "a": (None, None, AFTER_A, None)}
#: The state after a user or assistant turn that fits (inserted or reroled).
FITTING = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
NEXT_AFTER = {"s": AFTER_S, "u": AFTER_U, "a": AFTER_A}
ROLE_OF = {AFTER_U: "user", AFTER_A: "assistant"}
ACCEPTED = (START, AFTER_A)
MOST_INSERTS = 2  # between two turns: a third would only go round
#: Faults of a turn as the DP reads them.
SOUND, TRUNCATED, MUST_GO = range(3)
LEGAL = ("su", "ua", "au")


def best_edits(turns: list[tuple[str, int]]) -> tuple[int, str, list[tuple[int, int]], int]:
    """Cost, audit, for each turn (inserts before it, edit), and inserts at the end, of
    turns (initial, fault)."""
    places = (MOST_INSERTS + 1) * len(turns) + MOST_INSERTS
    high = DIGIT_BITS * places
    letters = (1 << high) - 1
    top = high - DIGIT_BITS

    def moved(rest: int) -> int:
        """The weight of a path with its letters one place further back."""
        low = rest & letters
        return rest - low + (low >> DIGIT_BITS)

    def edge(edit: int, cost: int) -> int:
        """What an edit in the first place adds to the moved weight of the path behind."""
        return (cost << high) + (edit << top)

    insert = edge(INSERT, INSERT_COST)
    delete = edge(DELETE, DELETE_COST)
    kept = [edge(KEEP, KEEP_COST), edge(KEEP, KEEP_COST + TRUNCATED_COST)]
    reroled = [edge(REROLE, REROLE_COST), edge(REROLE, REROLE_COST + TRUNCATED_COST)]

    def with_inserts(least: list[int | None], edits: list[int]) -> tuple[list[int | None], bytes]:
        out, chosen = [], bytearray()
        for state in range(4):
            options, at = [], state
            for k in range(MOST_INSERTS + 1):
                value = least[at]
                # inserts that cost more than what is there already cannot win
                if value is not None and not (options and (value >> high) + INSERT_COST * k
                                              > options[0][0] >> high):
                    for _ in range(k):
                        value = moved(value) + insert
                    options.append((value, k << 4 | edits[at]))
                at = FITTING[at]
            value, choice = min(options) if options else (None, 0)
            out.append(value)
            chosen.append(choice)
        return out, bytes(chosen)

    least: list[int | None] = [0 if q in ACCEPTED else None for q in range(4)]
    least, final = with_inserts(least, [0] * 4)
    chosen = []
    for initial, fault in reversed(turns):
        extra = fault == TRUNCATED
        behind = [None if v is None else moved(v) for v in least]
        here, edits = [], []
        for state in range(4):
            options = []
            if behind[state] is not None:
                options.append((behind[state] + delete, DELETE))
            if fault != MUST_GO:
                after = NEXT[initial][state] if initial in NEXT else None
                if after is not None and behind[after] is not None:
                    options.append((behind[after] + kept[extra], KEEP))
                if behind[FITTING[state]] is not None:
                    options.append((behind[FITTING[state]] + reroled[extra], REROLE))
            value, edit = min(options) if options else (None, 0)
            here.append(value)
            edits.append(edit)
        least, choice = with_inserts(here, edits)
        chosen.append(choice)
    state, steps, audit = START, [], []
    for (initial, _), choice in zip(turns, reversed(chosen), strict=True):
        inserts, edit = choice[state] >> 4, choice[state] & 15
        for _ in range(inserts):
            state = FITTING[state]
        state = (NEXT[initial][state] if edit == KEEP else FITTING[state] if edit == REROLE
                 else state)
        steps.append((inserts, edit))
        audit.append("I" * inserts + LETTERS[edit])
    ending = final[state] >> 4
    return least[START] >> high, "".join(audit) + "I" * ending, steps, ending


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: the conversations with planted faults; a
    dropped turn has 0 copies."""
    space = lambda c: F.coalesce(conversations[c].cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat_ws(":", space("conv_id"), space("turn")).cast("binary")),
                  F.lit(20))
    rows = conversations.select(
        conversations["conv_id"].cast("long").alias("conv_id"),
        conversations["turn"].cast("long").alias("turn"), space("role").alias("role"),
        space("text").alias("text"), kind.alias("kind"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(
            F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(
            F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)
        .cast("long").alias("copies"))


#: What the steps hand on: figures and audit of a conversation (kind 0), decisions (1),
#: texts (2); sorted, they come in that order.
HANDED = ("conv_id long, turn long, role string, digest binary, kind int, text string, "
          "became string, inserts int, figures array<long>")
_HANDED = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
                     ("digest", pa.binary()), ("kind", pa.int32()), ("text", pa.string()),
                     ("became", pa.string()), ("inserts", pa.int32()),
                     ("figures", pa.list_(pa.int64()))])
PLACE = ("conv_id", "turn", "role", "digest")


def in_order(rows: DataFrame, *columns: str) -> DataFrame:
    """Each conversation in one task, its rows in order (by a sort that can spill)."""
    return rows.repartition("conv_id").sortWithinPartitions(
        *[F.asc_nulls_first(c) for c in columns])


def _conversation(conv: int | None, held: list[dict]) -> list[dict]:
    """The figures and decisions of one conversation's counted turns."""
    held = [row for row in held if row["copies"]]
    turns, at, seen, numbers = [], [], set(), set()
    blank = duplicate = truncated = illegal = 0
    before = None
    for row in held:
        key, copies, initial = (row["role"], row["digest"]), row["copies"], row["role"][:1]
        fault = MUST_GO if row["blank"] or key in seen else TRUNCATED if row["cut"] else SOUND
        seen.add(key)
        blank += copies if row["blank"] else 0
        duplicate += 0 if row["blank"] else copies - (fault != MUST_GO)
        truncated += fault == TRUNCATED
        illegal += copies - 1 + (before is not None and before + initial not in LEGAL)
        before = initial
        at.append(len(turns))
        turns += [(initial, fault)] + [(initial, MUST_GO)] * (copies - 1)
        if row["turn"] is not None:
            numbers.add(row["turn"])
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    cost, audit, steps, ending = best_edits(turns)
    out = [dict(conv_id=conv, kind=0, text=audit, inserts=ending,
                figures=[gaps, blank, duplicate, truncated, illegal, cost])]
    state = START
    for row, i in zip(held, at, strict=True):  # further copies go, without an insert before them
        inserts, edit = steps[i]
        for _ in range(inserts):
            state = FITTING[state]
        became = None
        if edit == KEEP:
            state, became = NEXT[turns[i][0]][state], row["role"]
        elif edit == REROLE:
            state = FITTING[state]
            became = ROLE_OF[state]
        out.append(dict(conv_id=conv, turn=row["turn"], role=row["role"], digest=row["digest"],
                        kind=1, became=became, inserts=inserts))
    return out


#: Rows that a step gathers before it hands them on.
AT_ONCE = 4_000


def decided(turns: DataFrame) -> DataFrame:
    """The figures and decisions (HANDED, kinds 0 and 1) of conv_id, turn, role, text,
    copies."""
    counted = turns.select(
        "conv_id", "turn", "role", F.unhex(F.md5("text")).alias("digest"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"), "copies").groupBy(
        *PLACE, "blank", "cut").agg(F.sum("copies").alias("copies"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        out: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["conv_id"] != row["conv_id"]:
                    out += _conversation(held[0]["conv_id"], held)
                    held = []
                    if len(out) > AT_ONCE:
                        yield pa.RecordBatch.from_pylist(out, _HANDED)
                        out = []
                held.append(row)
        if held:
            out += _conversation(held[0]["conv_id"], held)
        if out:
            yield pa.RecordBatch.from_pylist(out, _HANDED)

    return on_executors(in_order(counted, *PLACE)).mapInArrow(run, HANDED)


REPAIRED = ("conv_id long, place long, role string, text string, audit string, "
            "figures array<long>")
_REPAIRED = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()),
                       ("text", pa.string()), ("audit", pa.string()),
                       ("figures", pa.list_(pa.int64()))])


def repaired(turns: DataFrame) -> DataFrame:
    """The repaired conversations, each in order in one partition: a row of place 0 with
    its audit and figures (gaps, blank, duplicate, truncated, illegal, cost), then its
    turns from place 1 on."""
    decisions = stored(decided(turns), "decisions")
    texts = turns.filter("copies > 0").select(
        "conv_id", "turn", "role", F.unhex(F.md5("text")).alias("digest"),
        F.lit(2).alias("kind"), "text")
    both = decisions.unionByName(texts, allowMissingColumns=True)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, place, state, ending, waiting = None, 0, START, 0, None
        out: list[dict] = []

        def turn(after: int, role: str, text: str) -> None:
            nonlocal place, state
            place, state = place + 1, after
            out.append(dict(conv_id=conv, place=place, role=role, text=text))

        def inserted(count: int) -> None:
            for _ in range(count):
                turn(FITTING[state], ROLE_OF[FITTING[state]], "")

        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    inserted(ending)
                    conv, place, state = row["conv_id"], 0, START
                    ending, waiting = row["inserts"], None
                    out.append(dict(conv_id=conv, place=0, audit=row["text"],
                                    figures=row["figures"]))
                elif row["kind"] == 1:
                    waiting = row if row["became"] is not None else None
                elif waiting:  # the first of equal texts
                    inserted(waiting["inserts"])
                    turn(NEXT_AFTER[waiting["became"][0]], waiting["became"], row["text"])
                    waiting = None
            if out:
                yield pa.RecordBatch.from_pylist(out, _REPAIRED)
                out.clear()
        inserted(ending)
        if out:
            yield pa.RecordBatch.from_pylist(out, _REPAIRED)

    return on_executors(in_order(both, *PLACE, "kind")).mapInArrow(run, REPAIRED)


def digested(repaired_rows: DataFrame) -> DataFrame:
    """conv_id, audit, figures, repaired_sha256 of the rows of :func:`repaired`."""
    schema = pa.schema([("conv_id", pa.int64()), ("audit", pa.string()),
                        ("figures", pa.list_(pa.int64())), ("repaired_sha256", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, value = None, hashlib.sha256()
        out: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if row["place"] == 0:
                    if current:
                        out.append(current | {"repaired_sha256": value.hexdigest()})
                    current = {k: row[k] for k in ("conv_id", "audit", "figures")}
                    value = hashlib.sha256()
                else:
                    line = f"{row['role']}:{row['text']}"
                    value.update((line if row["place"] == 1 else "\n" + line).encode())
            if len(out) > AT_ONCE:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if current:
            out.append(current | {"repaired_sha256": value.hexdigest()})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return repaired_rows.mapInArrow(
        run, "conv_id long, audit string, figures array<long>, repaired_sha256 string")


FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = digested(repaired(damaged(table(spark, sf_dir, "conversations"))))
    return found.select("conv_id", *[F.col("figures")[i].alias(n) for i, n in enumerate(FIGURES)],
                        "audit", "repaired_sha256")
