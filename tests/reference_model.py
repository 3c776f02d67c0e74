"""The lateness rules row by row in plain Python, to check the Spark forms against."""


def simulate(batches, window, delay, lateness):
    """``batches`` is a list of lists of ``(ms, type, area)``; gives (emissions, late rows)."""
    panes, fired, emissions, late, seen = {}, set(), [], [], None
    for number, rows in enumerate(batches):
        before = None if seen is None else max(seen, 0) - delay
        touched = set()
        for ms, kind, area in rows:
            start = ms - ms % window
            if before is not None and start + window - 1 + lateness <= before:
                late.append((number, ms, kind, area))
                continue
            panes.setdefault((start, kind, area), []).append(ms)
            touched.add((start, kind, area))
        seen = max([ms for ms, _, _ in rows] + ([] if seen is None else [seen]), default=None)
        if seen is None:
            continue
        after = max(seen, 0) - delay
        for key in panes:
            if key[0] + window - 1 <= after and (key in touched or key not in fired):
                fired.add(key)
                emissions.append((number, *key, len(panes[key]), max(panes[key])))
    finals = [(*key, len(times), max(times)) for key, times in panes.items()]
    return sorted(emissions), sorted(late), sorted(finals)
