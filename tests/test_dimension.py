import pytest

from auditflow.operators.asof import asof_max, running_max
from auditflow.operators.dimension import invert_areas, lookup_asof
from auditflow.sources.dimension import AreaDimension

# The sample area table.
AREAS = [("AREA_US", "US"), ("AREA_CT", "TW,HK"), ("AREA_AR", "PK,KW,SA"), ("AREA_IN", "IN")]


def areas(spark, rows):
    return spark.createDataFrame(rows, "area string, codes string")


def as_dict(codes):
    rows = codes.collect()
    assert len({r.countryCode for r in rows}) == len(rows)
    return {r.countryCode: r.area for r in rows}


def test_invert(spark):
    assert as_dict(invert_areas(areas(spark, AREAS))) == {
        "US": "AREA_US", "TW": "AREA_CT", "HK": "AREA_CT", "PK": "AREA_AR", "KW": "AREA_AR",
        "SA": "AREA_AR", "IN": "AREA_IN",
    }


def test_invert_edges(spark):
    rows = [("B", "PK,US,"), ("A", "US,,TW"), ("C", "TW, HK"), ("D", ","), ("E", None)]
    assert as_dict(invert_areas(areas(spark, rows))) == {
        "PK": "B", "US": "A", "": "A", "TW": "A", " HK": "C",
    }


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_running_max(spark, width):
    data = {-7: 2, -1: None, 0: 1, 2: 5, 3: 4, 9: None, 10: 9, 11: 1}
    df = spark.createDataFrame(list(data.items()), "at bigint, value bigint")
    got = {r.at: (r.max_upto, r.max_before)
           for r in running_max(df, "at", "value", width).collect()}
    seen, expected = None, {}
    for at in sorted(data):
        before = seen
        seen = max((v for v in (seen, data[at]) if v is not None), default=None)
        expected[at] = (seen, before)
    assert got == expected


def test_asof_max(spark):
    points = spark.createDataFrame([(0,), (5,), (7,), (7,), (40,)], "at bigint")
    refs = spark.createDataFrame([(5, 50), (6, 60), (30, 20)], "at bigint, value bigint")
    got = {r.at: r.value for r in asof_max(points, refs, 4).collect()}
    assert got == {0: None, 5: 50, 7: 60, 40: 60}


def test_snapshots_replace_each_other(spark):
    snapshots = spark.createDataFrame(
        [(1, "A", "US,TW"), (2, None, None), (4, "B", "US")],
        "version int, area string, codes string",
    )
    messages = spark.createDataFrame(
        [(batch, code) for batch in range(6) for code in ("US", "TW", None)],
        "batch_id bigint, countryCode string",
    )
    got = {(r.batch_id, r.countryCode): (r.version, r.area)
           for r in lookup_asof(messages, snapshots).collect()}
    assert len(got) == 18
    for batch in range(6):
        version = None if batch < 1 else 1 if batch < 4 else 4
        assert got[batch, "US"] == (version, {None: None, 1: "A", 4: "B"}[version])
        assert got[batch, "TW"] == (version, "A" if version == 1 else None)
        assert got[batch, None] == (version, None)


def test_refresh_keeps_the_last_good_snapshot(spark):
    now, loads = [0.0], []
    steps = iter([[], [("A", "US")], [("B", "TW")], [], None, [("C", "US")]])

    def load(session):
        rows = next(steps)
        loads.append(rows)
        if rows is None:
            raise ConnectionError("store is away")
        return areas(session, rows)

    dimension = AreaDimension(load, refresh_seconds=60, clock=lambda: now[0])

    def seen_at(moment):
        now[0] = moment
        return as_dict(dimension.current(spark))

    assert seen_at(0) == {}  # nothing yet: every lookup misses
    assert seen_at(59) == {} and len(loads) == 1
    assert seen_at(60) == {"US": "A"}
    assert seen_at(120) == {"TW": "B"}  # replaced as a whole
    assert seen_at(180) == {"TW": "B"}  # an empty table
    assert seen_at(240) == {"TW": "B"}  # a failed read
    assert seen_at(300) == {"US": "C"}
