"""Web-log operators: edge rows and invariants."""

from quarry.operators import weblog as wl


def _lines(spark, *lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_parse_no_bytes(spark):
    r = wl.parse_log(_lines(spark, 'a.ac.uk - - [01/Jul/1995:00:00:01 -0400] "GET / HTTP/1.0" 304 -')).first()
    assert r.host == "a.ac.uk" and r.timestamp == "01/Jul/1995:00:00:01 -0400"
    assert r.request == "GET / HTTP/1.0" and r.status == 304 and r.bytes is None


def test_parse_one_token(spark):
    r = wl.parse_log(_lines(spark, "x")).first()
    assert (r.host, r.timestamp, r.request, r.status, r.bytes) == ("", "", "", None, None)


def test_parse_more_than_two_quotes(spark):
    r = wl.parse_log(_lines(spark, 'h - - [t] "GET /a"b" HTTP" 200 5')).first()
    assert r.request == " HTTP" and r.status == 200 and r.bytes == 5


def test_org_keys(spark):
    from quarry.functions.logparse import org_key

    three = spark.createDataFrame([(h,) for h in ["www.cs.rl.ac.uk", "a-b.ac.uk", "ac.uk"]], "host string")
    got3 = {r.host: r.org for r in three.select("host", org_key("host", 3).alias("org")).collect()}
    assert got3 == {"www.cs.rl.ac.uk": "rl.ac.uk", "a-b.ac.uk": "a-b.ac.uk", "ac.uk": ""}
    two = spark.createDataFrame([(h,) for h in ["x.mit.edu", ".edu"]], "host string")
    got2 = {r.host: r.org for r in two.select("host", org_key("host", 2).alias("org")).collect()}
    assert got2 == {"x.mit.edu": "mit.edu", ".edu": ""}
    # Through the group pipeline the label count follows the group.
    df = spark.createDataFrame([("www.cs.rl.ac.uk",), ("x.mit.edu",)], "host string")
    got = {r.host: r.org for r in wl.with_org(wl.with_group(df)).collect()}
    assert got == {"www.cs.rl.ac.uk": "rl.ac.uk", "x.mit.edu": "mit.edu"}


def test_group_suffix_case_sensitive(spark):
    df = spark.createDataFrame([("A.AC.UK",), ("b.ac.uk",), ("c.com",)], "host string")
    got = {r.grp: r.requests for r in wl.requests_by_group(df).collect()}
    assert got == {"UK": 1, "JP": 0, "US": 0}


def test_top_k_tie_smaller_key_wins(spark):
    counts = spark.createDataFrame([("UK", "b", 5), ("UK", "a", 5), ("UK", "c", 9)],
                                   "grp string, org string, requests long")
    got = [(r.rank, r.org) for r in wl.top_k(counts, 2).orderBy("rank").collect()]
    assert got == [(1, "c"), (2, "a")]


def test_top_k_rest_totals_and_fewer_keys(spark):
    counts = spark.createDataFrame([("UK", "a", 3), ("UK", "b", 2)]
                                   + [("US", f"o{i:02d}", i) for i in range(1, 13)],
                                   "grp string, org string, requests long")
    out = wl.top_k_with_rest(counts, 9).collect()
    uk = {r.org: r.requests for r in out if r.grp == "UK"}
    assert uk == {"a": 3, "b": 2, "rest": 0}
    us = [r for r in out if r.grp == "US"]
    assert len(us) == 10
    assert sum(r.requests for r in us) == sum(range(1, 13))
    assert [r.requests for r in us if r.org == "rest"] == [1 + 2 + 3]


def test_share_sums_to_one(spark):
    counts = spark.createDataFrame([("UK", "a", 3), ("UK", "b", 1)], "grp string, org string, requests long")
    shares = wl.with_share(wl.top_k_with_rest(counts, 9)).collect()
    assert abs(sum(r.share for r in shares) - 1.0) < 1e-12


def test_leader_contains_vs_eq(spark):
    lines = ['a.dept1.ac.uk - - [01/Jul/1995:10:00:00 -0400] "GET /" 200 1'] * 3 + \
            ['a.xdept1.ac.uk - - [01/Jul/1995:11:00:00 -0400] "GET /" 200 1']
    parsed = wl.parse_log(_lines(spark, *lines))
    contains = wl.leader_requests(parsed).first()
    eq = wl.leader_requests(parsed, match="eq").first()
    assert contains.leader == "dept1.ac.uk" and contains.requests == 4
    assert eq.requests == 3


def test_heat_dense_zero_fill(spark):
    lines = ['h.mit.edu - - [01/Jul/1995:10:00:00 -0400] "GET /" 200 1',
             'h.mit.edu - - [03/Jul/1995:23:59:59 -0400] "GET /" 200 1',
             'h.mit.edu - - [03/Jul/1995:23:00:00 -0400] "GET /" 200 1']
    rows = wl.leader_rows(wl.parse_log(_lines(spark, *lines)))
    dense = wl.heat_dense(rows).collect()
    assert len(dense) == 3 * 24
    assert sum(r.requests for r in dense) == 3
    assert {(r.day, r.hour) for r in dense if r.requests} == {("01", "10"), ("03", "23")}
    assert wl.heat_peak(rows).first().peak_requests == 2
    span = wl.time_span(rows).first()
    assert str(span.first_request) == "1995-07-01 10:00:00"


def test_flagship_entry_runs(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert set(df.columns) == {"grp", "rank", "org", "requests"}
    rows = df.collect()
    assert rows and all(r.requests >= 0 for r in rows)


def test_cells_path_equals_row_path(spark, sf_small):
    from quarry.sources import standins as si

    parsed = wl.parse_log(si.load_access_log(spark, sf_small))
    rows = wl.leader_rows(parsed)
    lc = wl.leader_cells(wl.org_hour_cells(parsed))
    assert sorted(wl.heat_counts(rows).collect()) == sorted(wl.cell_heat(lc).collect())
    assert sorted(wl.time_span(rows).collect()) == sorted(wl.cell_span(lc).collect())
    assert sorted(wl.leader_requests(parsed).collect()) == sorted(wl.leader_cell_requests(lc).collect())
    assert wl.heat_dense(rows).collect() == wl.dense_grid(wl.cell_heat(lc), wl.cell_span(lc)).collect()


def test_heat_dense_keeps_cells_with_unparsable_time(spark):
    lines = ['h.mit.edu - - [01/Jul/1995:10:00:00 -0400] "GET /" 200 1',
             'h.mit.edu - - [07/Jul/1995:xx:yy -0400] "GET /" 200 1']
    rows = wl.leader_rows(wl.parse_log(_lines(spark, *lines)))
    dense = wl.heat_dense(rows).collect()
    assert sum(r.requests for r in dense) == 2
    assert len(dense) == 24 + 1


def test_heat_with_time_lacking_colons(spark):
    lines = ['h.mit.edu - - [01/Jul/1995:10:00:00 -0400] "GET /" 200 1',
             'h.mit.edu - - [garbage] "GET /" 200 1']
    rows = wl.leader_rows(wl.parse_log(_lines(spark, *lines)))
    cells = {(r.day, r.hour): r.requests for r in wl.heat_counts(rows).collect()}
    assert cells == {("01", "10"): 1, ("garbage", None): 1}
    assert sum(r.requests for r in wl.heat_dense(rows).collect()) == 2


def test_hosts_by_group(spark):
    lines = ['a.ac.uk - - [01/Jul/1995:10:00:00 -0400] "GET /" 200 1'] * 3 + \
            ['b.ac.uk - - [01/Jul/1995:10:00:00 -0400] "GET /" 200 1',
             'c.edu - - [01/Jul/1995:10:00:00 -0400] "GET /" 200 1']
    got = {r.grp: (r.hosts, r.requests) for r in wl.hosts_by_group(wl.parse_log(_lines(spark, *lines))).collect()}
    assert got == {"UK": (2, 4), "US": (1, 1), "JP": (0, 0)}
