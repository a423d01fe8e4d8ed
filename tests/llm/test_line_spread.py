import re
from collections import defaultdict

from corpus import SCHEMA, awkward, document, prose

from shelfwatch.llm import line_spread
from shelfwatch.llm.line_spread import drop_spread_lines


def expected(data, least):
    sites = defaultdict(set)
    for r in data:
        for line in (r[1] or "").split("\n"):
            if line.strip(" "):
                sites[line.strip(" ")].add(r[3])
    out = []
    for r in data:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if len(sites.get(x.strip(" "), ())) < least]
        out.append((r[0], len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def check(rows, data, least):
    got = drop_spread_lines(rows(SCHEMA, *data), min_sites=least).collect()
    assert sorted(((r.doc_id, r._n_lines, r._n_removed, r._kept) for r in got), key=str) == expected(data, least)


def lines():
    """Lines on 1 to 40 sites, with blanks, repeats and an empty line."""
    shared = [prose(700 + i, 6) for i in range(40)]
    return [
        document(site, "\n".join([prose(site, 9), *[s for i, s in enumerate(shared) if i >= site], "", "  " + shared[39], shared[39]]), source=f"s{site}")
        for site in range(40)
    ]


def test_spread_at_the_threshold(rows):
    for least in (2, 10, 30):
        check(rows, lines(), least)


def test_awkward_rows(rows, spark):
    check(rows, awkward(), 2)
    assert drop_spread_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sketches_decide_only_away_from_the_threshold(rows):
    # Far more sites than a sketch counts exactly: 3000 and 5000 around a threshold of 4000.
    data = [document(i, "rare" if i >= 3000 else "rare\nother", source=f"s{i}") for i in range(5000)]
    got = drop_spread_lines(rows(SCHEMA, *data), min_sites=4000)
    assert {re.sub("\n", "|", r._kept) for r in got.select("_kept").distinct().collect()} == {"", "other"}


def test_a_line_just_on_either_side_of_a_large_threshold(rows):
    # Estimates of 998 to 1002 sites err by some 16; only counting tells them apart.
    data = [
        document(i, "\n".join(f"line {n}" for n in range(998, 1003) if i < n), source=f"s{i}") for i in range(1002)
    ]
    for least in (999, 1001):
        check(rows, data, least)


def test_steps_written(rows, monkeypatch):
    """Of lines far below the threshold nothing is written, neither sketch nor sites."""
    written = {}
    plain = line_spread.staged
    monkeypatch.setattr(line_spread, "staged", lambda df, label: written.setdefault(label, plain(df, label)))
    line_spread.spread_lines(rows(SCHEMA, *lines()), min_sites=10)
    assert list(written) == ["line-spread", "boilerplate"]
    assert sorted(r.sites for r in written["line-spread"].collect())[0] == 9
