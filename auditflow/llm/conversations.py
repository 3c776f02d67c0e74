"""Conversation structure repair: damaged rows are told apart and edited at least cost."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditflow.llm.common import table
from auditflow.llm.glr import DELETE, GONE, INSERT, REROLE, Repairer
from auditflow.llm.quality import _CRC_TABLE, crc32_sql
from auditflow.session import stage

# Rows of a conversation that are parsed in one run.
RUN = 1_000
NAMES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
_TRAILING = " \t\n\x0b\x0c\r"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

_RUNS = (
    "conv_id long, part int, seq long, alone boolean, n long, first_turn long, last_turn long, turns long, "
    "first_role string, last_role string, illegal long, blank long, duplicate long, truncated long, "
    "symbols string, roles array<string>, texts array<string>"
)
_REPAIRED = (
    "conv_id long, part int, seq long, first_turn long, last_turn long, turns long, first_role string, last_role string, "
    "illegal long, blank long, duplicate long, truncated long, cost long, audit string, "
    "repaired array<struct<role: string, text: string>>"
)
_TOTALS = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


def _names(ddl: str) -> list[str]:
    return [f.name for f in _schema(ddl)]


def _schema(ddl: str) -> pa.Schema:
    """The Arrow form of the schemas above."""
    plain = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string()}

    def kind(text: str) -> pa.DataType:
        if text.startswith("array<"):
            return pa.list_(kind(text[6:-1]))
        if text.startswith("struct<"):
            return pa.struct([(name, plain[k]) for name, k in (f.split(": ") for f in text[7:-1].split(", "))])
        return plain[text]

    return pa.schema([(name, kind(k)) for name, k in re.findall(r"(\w+) ((?:[^,<]|<.*?>+)+)(?:, |$)", ddl)])


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` of the rows that a fixed damage leaves.

    The CRC32 of ``conv_id:turn`` modulo 20 decides: 0 drops a row, 1 empties its text, 2 takes out
    its sentence ends, 3 doubles it, 4 makes it the user's. Nulls stand as one space.
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    read = conversations.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind"))
    return read.where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).alias("copies"),
    )


def _in_order(rows: DataFrame) -> DataFrame:
    """Distinct rows with ``copies`` and ``first``, dealt out by range and in order in each partition."""
    same = ["conv_id", "turn", "role", "text"]
    rows = rows.groupBy(*same).agg(F.sum(F.col("copies").cast("long")).alias("copies"))
    mark = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    rows = stage(rows.withColumn("mark", mark), "turns")
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"))
    firsts = rows.groupBy(F.col("conv_id").alias("__id"), F.col("mark").alias("__mark")).agg(F.min(place).alias("__first"))
    told = rows.join(firsts, F.col("conv_id").eqNullSafe(F.col("__id")) & (F.col("mark") == F.col("__mark")))
    told = told.select(*same, "copies", "mark", (F.col("__first") == place).alias("first"))
    order = ["conv_id", "turn", "role", "mark"]
    dealt = told.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.select("conv_id", "turn", "role", "text", "copies", "first", F.spark_partition_id().alias("part"))


class _Run:
    """Rows of one conversation, read one after another."""

    def __init__(self, conv_id, part: int, seq: int):
        self.conv_id, self.part, self.seq = conv_id, part, seq
        self.turns, self.first_turn, self.last_turn = 0, None, None
        self.first_role = self.last_role = None
        self.illegal = self.blank = self.duplicate = self.truncated = 0
        self.symbols: list[str] = []
        self.roles: list[str] = []
        self.texts: list[str] = []

    def add(self, turn, role: str, text: str, first: bool) -> None:
        if turn is not None and (not self.turns or turn != self.last_turn):
            self.turns += 1
        if turn is not None:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        initial = role[:1]
        if self.last_role is not None:
            self.illegal += self.last_role + initial not in LEGAL
        else:
            self.first_role = initial
        self.last_role = initial
        ends = text.rstrip(_TRAILING)
        symbol = initial if initial in ("s", "u", "a") else "x"
        if not ends:
            self.blank, symbol = self.blank + 1, GONE
        elif not first:
            self.duplicate, symbol = self.duplicate + 1, GONE
        elif ends[-1] not in ".!?":
            self.truncated, symbol = self.truncated + 1, symbol.upper()
        self.symbols.append(symbol)
        self.roles.append("" if symbol == GONE else role)
        self.texts.append("" if symbol == GONE else text)

    def row(self, alone: bool) -> tuple:
        return (
            self.conv_id, self.part, self.seq, alone, len(self.symbols), self.first_turn, self.last_turn, self.turns,
            self.first_role, self.last_role, self.illegal, self.blank, self.duplicate, self.truncated,
            "".join(self.symbols), self.roles, self.texts,
        )


def _batches(rows: Iterator[tuple], ddl: str, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded size."""
    schema = _schema(ddl)
    held, weight = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        weight += 200 + sum(len(x) if isinstance(x, str) else sum(map(len, x)) for x in row if isinstance(x, (str, list)))
        if weight >= size:
            yield batch()
            held, weight = [], 0
    if held:
        yield batch()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _scan(size: int):
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        run, leading = None, True
        for conv_id, turn, role, text, copies, first, part in _rows(batches):
            if run is None:
                run = _Run(conv_id, part, 0)
            elif conv_id != run.conv_id:
                # The first and the last conversation of a partition may go on in the next one.
                yield run.row(run.seq == 0 and not leading)
                run, leading = _Run(conv_id, part, 0), False
            for copy in range(copies):
                if len(run.symbols) >= size:
                    yield run.row(False)
                    run = _Run(conv_id, part, run.seq + 1)
                run.add(turn, role, text, first and not copy)
        if run:
            yield run.row(False)

    return lambda batches: _batches(runs(batches), _RUNS)


def _edited(symbols: str, roles: list[str], texts: list[str], audit: str, before: int, system: bool) -> list[dict]:
    """Rows of a run after its edits; ``before`` rows of the repaired conversation precede them."""
    out, at, place = [], 0, before
    for edit in audit:
        if edit == DELETE:
            at += 1
            continue
        if place == 0:
            system = edit not in (REROLE, INSERT) and symbols[at].lower() == "s"
        turn = NAMES["ua"[(place - system) % 2]]
        if edit == INSERT:
            out.append({"role": turn, "text": ""})
        else:
            out.append({"role": turn if edit == REROLE else roles[at], "text": texts[at]})
            at += 1
        place += 1
    return out


_PARSER: list[Repairer] = []


def _parser() -> Repairer:
    if not _PARSER:
        _PARSER.append(Repairer())
    return _PARSER[0]


_SUMMARY = slice(5, 14)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def repaired() -> Iterator[tuple]:
        for row in _rows(batches):
            symbols, roles, texts = row[-3:]
            cost, audit = _parser().repair(symbols)
            yield (*row[:3], *row[_SUMMARY], cost, audit, _edited(symbols, roles, texts, audit, 0, False))

    return _batches(repaired(), _REPAIRED)


_TABLE = "conv_id long, part int, seq long, n long, symbols string, moves array<struct<start: int, end: int, cost: int, audit: string>>"
_SEGMENTS = "conv_id long, part int, seq long, audit string, before long, system boolean"


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for *key, n, symbols in _rows(batches):
            moves = _parser().table(symbols)
            yield (*key, n, symbols, [dict(zip(("start", "end", "cost", "audit"), m)) for m in moves])

    return _batches(rows(), _TABLE)


def _grouped(rows: Iterator[tuple]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Runs of rows of equal first column; each has to be read before the next."""
    return groupby(rows, key=lambda row: row[0])


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for _, runs in _grouped(_rows(batches)):
            keys: list[tuple] = []

            def moves(runs=runs, keys=keys):
                for *key, n, symbols, table in runs:
                    keys.append((key, symbols))
                    yield n, [(m["start"], m["end"], m["cost"], m["audit"]) for m in table]

            before, system = 0, False
            for audit in _parser().chained(moves()):
                key, symbols = keys.pop(0)
                yield (*key, audit, before, system)
                stays = [e for e in audit if e != DELETE]
                if not before and stays:
                    at = len(audit[:audit.index(stays[0])])
                    system = stays[0] == "K" and symbols[at].lower() == "s"
                before += len(stays)

    return _batches(rows(), _SEGMENTS)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for row in _rows(batches):
            symbols, roles, texts, audit, before, system = row[-6:]
            yield (
                *row[:3], *row[_SUMMARY], _parser().cost(symbols, audit), audit,
                _edited(symbols, roles, texts, audit, before, system),
            )

    return _batches(rows(), _REPAIRED)


def repair(rows: DataFrame, run: int = RUN) -> DataFrame:
    """Repaired conversations, in runs of up to ``run`` rows each.

    ``rows`` has ``conv_id, turn, role, text`` and ``copies``, how often a row stands there. Each
    conversation is taken by turn, nulls first, ties by role and MD5 of role and text; its rows must
    become a sentence of the role grammar, by the first letter of their role. Blank rows and those
    whose role and text stood earlier have to go; see ``glr`` for the edits and their costs. Of the
    repairs of least cost that with the least audit is taken.

    A row per run, in the order of ``part, seq``: ``conv_id``, first and last turn and role, counts
    of faults, ``cost``, ``audit`` and ``repaired``, the rows that stand after the edits.

    Rows are dealt out by range, so a conversation of any length is spread over tasks, and equal rows
    are one row with a count. A conversation that one task holds within a run is parsed at once. Of a
    longer one each run is parsed from every stack it may start with; only these tables meet in
    order, and what they decide goes back to the runs. A null conv_id is a conversation; null roles
    and texts are not expected (see ``damaged``), other columns are not read, an empty table gives
    an empty result.
    """
    runs = stage(_in_order(rows).mapInArrow(_scan(run), _RUNS), "runs")
    names = _names(_RUNS)
    alone = runs.where("alone").mapInArrow(_whole, _REPAIRED)
    open_runs = runs.where("not alone")
    order = ["conv_id", "part", "seq"]
    tables = open_runs.select(*order, "n", "symbols").mapInArrow(_tables, _TABLE)
    settled = tables.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_chain, _SEGMENTS)
    keys = settled.select(
        F.col("conv_id").alias("__id"), F.col("part").alias("__part"), F.col("seq").alias("__seq"), "audit", "before", "system"
    )
    met = open_runs.join(
        keys, F.col("conv_id").eqNullSafe(F.col("__id")) & (F.col("part") == F.col("__part")) & (F.col("seq") == F.col("__seq"))
    )
    return alone.unionByName(met.select(*names, "audit", "before", "system").mapInArrow(_pieces, _REPAIRED))


def repaired_rows(repaired: DataFrame) -> DataFrame:
    """``conv_id, part, seq, place, role, text``: the conversations after repair, row by row."""
    rows = repaired.select("conv_id", "part", "seq", F.posexplode("repaired").alias("place", "row"))
    return rows.select("conv_id", "part", "seq", "place", "row.role", "row.text")


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for conv_id, runs in _grouped(_rows(batches)):
            turns, low, high, role = 0, None, None, None
            sums, cost, audits, digest, empty = [0, 0, 0, 0], 0, [], hashlib.sha256(), True
            for *_, first_turn, last_turn, n, first_role, last_role, illegal, blank, duplicate, truncated, c, audit, lines in runs:
                if first_turn is not None:
                    turns += n - (high == first_turn)
                    low, high = first_turn if low is None else low, last_turn
                illegal += role is not None and role + first_role not in LEGAL
                role = last_role
                sums = [a + b for a, b in zip(sums, (blank, duplicate, truncated, illegal))]
                cost += c
                audits.append(audit)
                for line in lines:
                    digest.update(("" if empty else "\n").encode() + f"{line['role']}:{line['text']}".encode())
                    empty = False
            gaps = 0 if low is None else high - low + 1 - turns
            yield (conv_id, gaps, *sums, cost, "".join(audits), digest.hexdigest())

    return _batches(rows(), _TOTALS)


def summaries(repaired: DataFrame) -> DataFrame:
    """A row per conversation: gaps, faults, cost, audit and a digest of the repaired rows.

    Runs come in order; each is read and let go. The digest of a conversation is one sequence of
    bytes by its nature, so its runs pass through one task, but never together.
    """
    in_order = repaired.select(*_names(_REPAIRED)).repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return in_order.mapInArrow(_totals, _TOTALS)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and repair of every conversation after the fixed damage."""
    conversations = table(spark, sf_dir, "conversations")
    found = summaries(repair(damaged(conversations)))
    every = conversations.select(F.col("conv_id").alias("__id")).distinct()
    joined = every.join(found, F.col("__id").eqNullSafe(F.col("conv_id")), "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return joined.select(
        F.col("__id").alias("conv_id"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )


def _sql() -> str:
    """The same rows by dynamic programming over the states of the grammar: nothing, s, u, a.

    A state's value is its cost in nine digits and its audit, so the lesser text is the better one.
    """
    add = lambda v, cost, edit: (
        f"(lpad(CAST(CAST(left({v}, 9) AS INT) + {cost} AS VARCHAR), 9, '0') || substr({v}, 10) || '{edit}')"
    )
    own = lambda to, frm, more: (
        f"CASE WHEN lower(x[1]) = '{to}' THEN {add(frm, more, 'K')} ELSE {add(frm, more + 3, 'R')} END"
    )

    def moved(more: int) -> str:
        system = f"CASE WHEN lower(x[1]) = 's' THEN {add('q[1]', more, 'K')} END"
        return (
            f"[{add('q[1]', 4, 'D')}, least({add('q[2]', 4, 'D')}, {system}), "
            f"least({add('q[3]', 4, 'D')}, {own('u', 'least(q[1], q[2], q[4])', more)}), "
            f"least({add('q[4]', 4, 'D')}, {own('a', 'q[3]', more)})]"
        )

    inserted = (
        f"[q[1], q[2], least(q[3], {add('q[1]', 3, 'I')}, {add('q[2]', 3, 'I')}, {add('q[4]', 3, 'I')}), "
        f"least(q[4], {add('q[3]', 3, 'I')})]"
    )
    deleted = "[" + ", ".join(add(f"q[{i}]", 4, "D") for i in range(1, 5)) + "]"
    step = (
        f"CASE WHEN x[1] = '+' THEN {inserted} WHEN x[1] = 'd' THEN {deleted} "
        f"WHEN x[1] = upper(x[1]) THEN {moved(3)} ELSE {moved(0)} END"
    )
    return rf"""
WITH crc AS MATERIALIZED (SELECT {_CRC_TABLE} AS crc
), kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')", 'crc')} % 20 AS kind
  FROM conversations, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0
), placed AS (
  SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, role, md5(CAST(length(role) AS VARCHAR) || ':' || role || text)) AS i FROM damaged
), faults AS (
  SELECT *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS core,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
  FROM placed
), told AS (
  SELECT *, CASE WHEN core = '' THEN 'blank' WHEN again THEN 'duplicate'
    WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    CASE WHEN initial IN ('s', 'u', 'a') THEN initial ELSE 'x' END AS letter
  FROM faults
), parsed AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
    list_reduce(list_concat(flatten(list([['+'], ['+'], [
        CASE WHEN fault IN ('blank', 'duplicate') THEN 'd' WHEN fault = 'truncated' THEN upper(letter) ELSE letter END]] ORDER BY i)), [['+'], ['+']]),
      lambda q, x: {step}, ['000000000', NULL, NULL, NULL]) AS q
  FROM told GROUP BY conv_id
), best AS (SELECT *, substr(least(q[1], q[4]), 10) AS audit, CAST(left(least(q[1], q[4]), 9) AS BIGINT) AS cost FROM parsed
), letters AS (
  SELECT conv_id, edit, j, count(*) FILTER (edit <> 'I') OVER w AS i, count(*) FILTER (edit <> 'D') OVER w AS p
  FROM (SELECT conv_id, unnest(string_split(audit, '')) AS edit, generate_subscripts(string_split(audit, ''), 1) AS j FROM best)
  WHERE edit <> '' WINDOW w AS (PARTITION BY conv_id ORDER BY j ROWS UNBOUNDED PRECEDING)
), stays AS (
  SELECT l.*, t.role, t.text, coalesce(bool_or(p = 1 AND edit = 'K' AND initial = 's') OVER (PARTITION BY l.conv_id), false) AS s
  FROM letters l LEFT JOIN told t ON l.conv_id IS NOT DISTINCT FROM t.conv_id AND l.i = t.i WHERE edit <> 'D'
), repaired AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (p - CAST(s AS INT)) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS lines
  FROM stays GROUP BY conv_id
), every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM every e LEFT JOIN best b ON e.conv_id IS NOT DISTINCT FROM b.conv_id
  LEFT JOIN repaired r ON e.conv_id IS NOT DISTINCT FROM r.conv_id
"""


OP12_SQL = _sql()
