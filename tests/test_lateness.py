import random

import golden
import pytest
from reference_model import simulate

from auditflow.operators import lateness
from auditflow.operators.reporting import count_panes, window_start
from auditflow.operators.rules import ReportRules
from auditflow.session import stage
from pyspark.sql import functions as F

ROW = "batch_id bigint, event_ms bigint, type string, area string"
RULES = ReportRules()


def replayed(spark, batches, rules):
    """Emissions, late rows and finals of the batch form."""
    flat = [(n, *row) for n, rows in enumerate(batches) for row in rows]
    rows = spark.createDataFrame(flat, ROW)
    panes = stage(count_panes(rows, rules, "batch_id"), "panes")
    marks = stage(lateness.batch_watermark(panes, rules), "marks")
    on_time, late_panes = lateness.split_late(panes, marks, rules)
    log = lateness.changelog(on_time, lateness.fire_batches(panes, marks, rules))
    windowed = rows.withColumn("window_start_ms", window_start(F.col("event_ms"), rules))
    late = lateness.late_rows(windowed, late_panes)
    return (
        [tuple(r) for r in log.collect()],
        [tuple(r) for r in late.select("batch_id", "event_ms", "type", "area").collect()],
        [tuple(r) for r in lateness.final_panes(on_time).collect()],
        log,
    )


def random_batches(seed, rules):
    """Disordered rows; one pane key holds about a third of them, and some batches are empty."""
    chance = random.Random(seed)
    batches, now = [], golden.DAY_MS
    for _ in range(14):
        size = chance.choice([0, 1, 5, 30])
        rows = []
        for _ in range(size):
            now += chance.randrange(0, rules.window_ms // 3)
            back = chance.choice([0, 0, rules.delay_ms, 2 * rules.window_ms])
            moment = (now - chance.randrange(0, back + 1)) // 1000 * 1000
            key = ("hot", "X") if chance.random() < 0.33 else (
                chance.choice("abc"), chance.choice("XY"))
            rows.append((moment, *key))
        batches.append(rows)
    return batches


def test_golden_case(spark):
    batches = [[(golden.ms(t), "a", "X") for t in times] for times in golden.BATCHES]
    emissions, late, finals, _ = replayed(spark, batches, RULES)
    assert sorted(emissions) == [
        (b, golden.ms(w), "a", "X", n, golden.ms(t)) for b, w, n, t in golden.EMISSIONS
    ]
    assert late == [(golden.LATE[0], golden.ms(golden.LATE[1]), "a", "X")]
    assert sorted((w, n) for w, _, _, n, _ in finals) == [
        (golden.ms(w), n) for w, n in golden.FINALS
    ]


def test_golden_watermarks(spark):
    panes = spark.createDataFrame(
        [(n, golden.ms(t)) for n, times in enumerate(golden.BATCHES) for t in times],
        "batch_id bigint, max_ms bigint",
    )
    marks = sorted(tuple(r) for r in lateness.batch_watermark(panes, RULES).collect())
    after = [golden.ms(t) for t in ("00:00:10", "00:00:55", "00:01:05", "00:01:05", "00:01:35",
                                    "00:01:36", "00:02:50")]
    assert marks == list(zip(range(7), [None, *after[:-1]], after))


def test_watermark_never_starts_below_the_epoch(spark):
    panes = spark.createDataFrame([(0, -5_000), (1, 3_000)], "batch_id bigint, max_ms bigint")
    marks = sorted(tuple(r) for r in lateness.batch_watermark(panes, RULES).collect())
    assert marks == [(0, None, -10_000), (1, -10_000, -7_000)]


@pytest.mark.parametrize("seed", range(4))
def test_against_the_row_by_row_model(spark, seed):
    rules = ReportRules(lateness_ms=[30_000, 0, 45_000, 120_000][seed])
    batches = random_batches(seed, rules)
    emissions, late, finals, log = replayed(spark, batches, rules)
    expected = simulate(batches, rules.window_ms, rules.delay_ms, rules.lateness_ms)
    assert (sorted(emissions), sorted(late), sorted(finals)) == expected

    # Final and late rows together are the whole input.
    assert sum(f[3] for f in finals) + len(late) == sum(len(b) for b in batches)
    by_pane = {}
    for emission in sorted(emissions):
        by_pane.setdefault(emission[1:4], []).append(emission)
    assert sorted(tuple(r) for r in lateness.first_emissions(log).collect()) == sorted(
        e[0] for e in by_pane.values()
    )
    assert sorted(tuple(r) for r in lateness.last_emissions(log).collect()) == sorted(
        e[-1] for e in by_pane.values()
    )


def test_scans_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(lateness, "BATCHES_PER_BUCKET", 2)
    monkeypatch.setattr(lateness, "WINDOWS_PER_BUCKET", 1)
    rules = ReportRules()
    batches = random_batches(11, rules)
    emissions, late, finals, _ = replayed(spark, batches, rules)
    expected = simulate(batches, rules.window_ms, rules.delay_ms, rules.lateness_ms)
    assert (sorted(emissions), sorted(late), sorted(finals)) == expected


def slowest_marks(rows, rules, partitions, idle):
    """Watermarks batch by batch, as a reader of several partitions would keep them."""
    seen, last, mark, out = [0] * partitions, [-1] * partitions, -rules.delay_ms, []
    for number, batch in enumerate(sorted({b for b, _, _ in rows})):
        before = mark if out else None
        for b, part, ms in rows:
            if b == batch and part is not None and 0 <= part < partitions:
                seen[part], last[part] = max(seen[part], ms), number
        held = [s for s, at in zip(seen, last) if idle is None or number - at < idle]
        if held:
            mark = max(mark, min(held) - rules.delay_ms)
        out.append((batch, before, mark))
    return out


@pytest.mark.parametrize("idle", [None, 1, 2, 3])
@pytest.mark.parametrize("seed", range(3))
def test_the_slowest_partition_holds_the_watermark(spark, monkeypatch, seed, idle):
    monkeypatch.setattr(lateness, "BATCHES_PER_BUCKET", 4)
    draw, rules = random.Random(seed), ReportRules()
    rows = [
        (b, part, draw.randint(-5, 40) * 1_000 + b * 3_000)
        for b in sorted(draw.sample(range(-3, 40), 18)) for part in draw.sample([0, 1, 2, 7, None], draw.randint(1, 4))
    ]
    df = spark.createDataFrame(rows, "batch_id bigint, partition int, max_ms bigint")
    marks = lateness.partition_watermark(df, rules, 3, idle)
    assert sorted(map(tuple, marks.collect())) == slowest_marks(rows, rules, 3, idle)


def test_one_partition_is_the_plain_watermark(spark):
    rows = [(b, 0, ms) for b, ms in ((0, 5_000), (1, 90_000), (3, 20_000), (4, 95_000))]
    df = spark.createDataFrame(rows, "batch_id bigint, partition int, max_ms bigint")
    plain = lateness.batch_watermark(df, ReportRules())
    assert sorted(map(tuple, lateness.partition_watermark(df, ReportRules(), 1).collect())) == sorted(map(tuple, plain.collect()))
    assert lateness.partition_watermark(df.limit(0), ReportRules(), 2).count() == 0
