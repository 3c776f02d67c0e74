"""The lateness case worked out by hand (window 60 s, delay 10 s, lateness 30 s)."""

BATCHES = [
    ["00:00:05", "00:00:20"],
    ["00:01:05"],
    ["00:01:15", "00:00:50"],
    ["00:00:55"],
    ["00:01:45"],
    ["00:00:10", "00:01:46"],
    ["00:03:00"],
]

# Batch, window start, count, latest time.
EMISSIONS = [
    (2, "00:00:00", 3, "00:00:50"),
    (3, "00:00:00", 4, "00:00:55"),
    (6, "00:01:00", 4, "00:01:46"),
]
LATE = (5, "00:00:10")
FINALS = [("00:00:00", 4), ("00:01:00", 4), ("00:03:00", 1)]

DAY_MS = 1_704_067_200_000  # 2024-01-01 in UTC


def ms(clock: str) -> int:
    hours, minutes, seconds = map(int, clock.split(":"))
    return DAY_MS + (hours * 3600 + minutes * 60 + seconds) * 1000


def message(clock: str) -> str:
    return f'{{"dt":"2024-01-01 {clock}","type":"a","username":"u","area":"X"}}'
