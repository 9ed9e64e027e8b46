"""Property tests: Spark column functions against plain-Python statements of the same rules."""

import datetime as dt
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.functions import parse_rfc3339, parse_semver, rfc3339, semver_text


def semver_rule(text: str):
    """The version rule in Python: 1-3 dot parts, each unsigned decimal 0..1023."""
    parts = text.split(".")
    if not parts[0] or len(parts) > 3:
        return None
    out = []
    for p in parts:
        if not p or not all(c in "0123456789" for c in p):
            return None
        v = int(p)
        if v > 1023:
            return None
        out.append(v)
    out += [0] * (3 - len(out))
    return ".".join(map(str, out))


VERSIONS = st.one_of(
    st.text(alphabet="0123456789.", max_size=12),
    st.text(alphabet="0123456789.-+_ a", max_size=8),
    st.builds(lambda a, b, c: f"{a}.{b}.{c}", st.integers(0, 1100), st.integers(0, 1100), st.integers(0, 1100)),
    st.builds(lambda z, a: "0" * z + str(a), st.integers(0, 45), st.integers(0, 2000)),
)


@settings(max_examples=30, deadline=None)
@given(st.lists(VERSIONS, min_size=1, max_size=60))
def test_semver_matches_rule(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["v"] for r in df.select("t", semver_text(parse_semver("t")).alias("v")).collect()}
    for t in texts:
        want = semver_rule(t)
        assert (got[t] or None) == want, t


RFC = re.compile(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2})$")


def rfc_rule(text: str) -> str:
    if text is None or not RFC.match(text):
        return "0001-01-01T00:00:00Z"
    base = dt.datetime.strptime(text[:19], "%Y-%m-%dT%H:%M:%S")
    zone = text[-1] if text.endswith("Z") else text[-6:]
    if zone != "Z":
        sign = 1 if zone[0] == "+" else -1
        base -= sign * dt.timedelta(hours=int(zone[1:3]), minutes=int(zone[4:6]))
    return base.strftime("%Y-%m-%dT%H:%M:%SZ")


STAMPS = st.builds(
    lambda d, frac, zone: d.strftime("%Y-%m-%dT%H:%M:%S") + frac + zone,
    st.datetimes(min_value=dt.datetime(1971, 1, 1), max_value=dt.datetime(2099, 12, 31)),
    st.sampled_from(["", ".1", ".123456", ".123456789"]),
    st.sampled_from(["Z", "+02:00", "-05:30", "+00:00", "", "z"]),
)


@settings(max_examples=20, deadline=None)
@given(st.lists(STAMPS, min_size=1, max_size=40))
def test_rfc3339_matches_rule(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["p"] for r in df.select("t", rfc3339(parse_rfc3339("t")).alias("p")).collect()}
    for t in texts:
        assert got[t] == rfc_rule(t), t
