"""Property checks against brute force on generated inputs where one
subscriber / one location holds about a third of all rows."""

from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import make_inputs, rows
from usagelens.operators.counting import KEYS, RECORDS, SUBSCRIBERS
from usagelens.plans import activity_snapshot, network

SUBS = [str(i) for i in range(12)]
CODES = [f"L{i}" for i in range(8)]
HOT_SUB, HOT_CODE = "0", "L0"


def _hot(options, hot):
    # about one draw in three is the hot value
    return st.one_of(st.just(hot), st.sampled_from(options), st.sampled_from(options))


voice_rows = st.lists(st.tuples(_hot(SUBS, HOT_SUB), st.integers(0, 500), _hot(CODES, HOT_CODE)),
                      max_size=40)
sms_rows = st.lists(st.tuples(_hot(SUBS, HOT_SUB), st.sampled_from(["a", "b", None]),
                              _hot(CODES, HOT_CODE)), max_size=40)
volume_rows = st.lists(st.tuples(_hot(SUBS, HOT_SUB), st.sampled_from([" ", "0", "7", "12"]),
                                 st.sampled_from([" ", "3", "40"])), max_size=40)
catalogue = st.lists(st.tuples(st.sampled_from(CODES), st.sampled_from(["EU", "AS", None])),
                     max_size=10)

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture,
                                           HealthCheck.too_slow])


def _volume(v):
    return 0 if v == " " else int(v)


@SETTINGS
@given(voice=voice_rows, sms=sms_rows, volume=volume_rows)
def test_activity_snapshot_matches_brute_force(spark, voice, sms, volume):
    vol = [(s, u, d, 1, i) for i, (s, u, d) in enumerate(volume)]
    inp = make_inputs(spark, voice=voice, sms=sms, volume=vol)
    expected = {}
    for s in {r[0] for r in voice} | {r[0] for r in sms} | {r[0] for r in volume}:
        durations = [d for sub, d, _ in voice if sub == s]
        expected[int(s)] = (int(s), min(durations, default=0), max(durations, default=0),
                            sum(1 for r in sms if r[0] == s),
                            sum(_volume(u) for sub, u, _ in volume if sub == s),
                            sum(_volume(d) for sub, _, d in volume if sub == s))
    assert rows(activity_snapshot(inp)) == sorted(expected.values(), key=lambda t: str(t[0]))


@SETTINGS
@given(sms=sms_rows, locations=catalogue)
def test_country_counts_match_brute_force_in_every_mode(spark, sms, locations):
    inp = make_inputs(spark, sms=sms, locations=locations)
    names = {}  # smallest non-null country per code
    for code, country in locations:
        if country is not None:
            names[code] = min(names.get(code, country), country)
    label = {c: names.get(c, f"{c} country") for c in CODES}
    keys, records, subs = Counter(), Counter(), defaultdict(set)
    for code in {c for _, _, c in sms}:
        keys[label[code]] += 1
    for sub, _, code in sms:
        records[label[code]] += 1
        subs[label[code]].add(sub)
    got = {m: dict(rows(network.country_counts(inp, network.SMS, m)))
           for m in (KEYS, RECORDS, SUBSCRIBERS)}
    assert got[KEYS] == dict(keys)
    assert got[RECORDS] == dict(records)
    assert got[SUBSCRIBERS] == {k: len(v) for k, v in subs.items()}


PLAN_IDS = list(range(1, 9))
NAMES = ["A", "B", "C", "D", None]

usage_rows = st.lists(st.tuples(_hot(SUBS, HOT_SUB), st.one_of(st.sampled_from(PLAN_IDS), st.none())),
                      max_size=40)
ages = st.lists(st.tuples(st.sampled_from(SUBS), st.integers(0, 90)), max_size=15)
plan_catalogue = st.lists(st.tuples(st.sampled_from(PLAN_IDS[:6]), st.sampled_from(NAMES)),
                          max_size=10)


def _brute_trends(usage, subs, catalogue, k=5):
    """The original's co-group steps, literally (keys mode)."""
    names = {}
    for pid, name in catalogue:
        if name is not None:
            names[pid] = min(names.get(pid, name), name)

    def label(pid):
        return names.get(pid, "General Plan")

    def ranked(keys):
        counts = Counter(label(pid) for pid in keys)
        top = sorted(counts, key=lambda n: (-counts[n], n))[:k]
        least = sorted(counts, key=lambda n: (counts[n], n))[:k]
        return top, least

    series = {"all": {pid for _, pid, _ in usage}}
    first = {}
    for sub, pid, seq in sorted(usage, key=lambda r: (r[2], r[1] is None, r[1] or 0)):
        first.setdefault(sub, pid)
    band_of = {"50_plus": lambda a: a >= 50, "30_50": lambda a: 30 <= a < 50,
               "18_30": lambda a: 18 <= a < 30, "18_less": lambda a: a < 18}
    for band, test in band_of.items():
        members = {sub for sub, age in subs if test(age)}
        series[band] = {first[s] for s in members if s in first}
    lists = {}
    for name, keys in series.items():
        lists["top_" + name], lists["least_" + name] = ranked(keys)
    depth = max((len(v) for v in lists.values()), default=0)
    return lists, depth


@settings(SETTINGS, max_examples=5)
@given(usage=usage_rows, subs=ages, catalogue=plan_catalogue)
def test_rate_plan_trends_matches_brute_force(spark, usage, subs, catalogue):
    from usagelens.plans import trends
    usage = [(s, pid, i) for i, (s, pid) in enumerate(usage)]
    inp = make_inputs(spark, volume=[(s, "1", "1", pid, seq) for s, pid, seq in usage],
                      subscriber=[f"{s},a,b,c,d,{a}" for s, a in subs], plans=catalogue)
    lists, depth = _brute_trends(usage, subs, catalogue)
    out = trends.rate_plan_trends(inp, KEYS).orderBy("rank").collect()
    assert [r["rank"] for r in out] == list(range(1, depth + 1))
    for series, column in trends.SERIES_COLUMNS.items():
        expected = lists[series] + ["General Plan"] * (depth - len(lists[series]))
        assert [r[column] for r in out] == expected, series


def _brute_network(sms, voice, locations, k=5):
    names = {}
    for code, country in locations:
        if country is not None:
            names[code] = min(names.get(code, country), country)
    lists = {}
    for series, rows_ in (("sms", sms), ("voice", voice)):
        counts = Counter(names.get(code, f"{code} country") for code in {r[2] for r in rows_})
        lists["top_" + series] = sorted(counts, key=lambda n: (-counts[n], n))[:k]
        lists["least_" + series] = sorted(counts, key=lambda n: (counts[n], n))[:k]
    return lists, max((len(v) for v in lists.values()), default=0)


@settings(SETTINGS, max_examples=5)
@given(sms=sms_rows, voice=voice_rows, locations=catalogue)
def test_network_activity_matches_brute_force(spark, sms, voice, locations):
    inp = make_inputs(spark, sms=sms, voice=voice, locations=locations)
    lists, depth = _brute_network(sms, voice, locations)
    out = network.network_activity(inp, KEYS).orderBy("rank").collect()
    assert [r["rank"] for r in out] == list(range(1, depth + 1))
    for series, column in network.SERIES_COLUMNS.items():
        expected = lists[series] + ["Not known"] * (depth - len(lists[series]))
        assert [r[column] for r in out] == expected, series
