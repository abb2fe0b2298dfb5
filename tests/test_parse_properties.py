"""Property: on well-formed combined-format lines the eight independent
patterns and the strict whole-line pattern agree, and both return the parts
the line was built from."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from tidelog.functions.parse import parse_logs

MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()
token = st.text(alphabet=st.characters(min_codepoint=33, max_codepoint=126, blacklist_characters='"'), min_size=1, max_size=12)
agent = st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=126, blacklist_characters='"'), max_size=30)


@st.composite
def log_line(draw):
    ip = ".".join(str(draw(st.integers(0, 255))) for _ in range(4))
    when = draw(st.datetimes(dt.datetime(2000, 1, 1), dt.datetime(2030, 12, 31)))
    sign = draw(st.sampled_from("+-"))
    hh, mm = draw(st.integers(0, 14)), draw(st.sampled_from([0, 30, 45]))
    zone = f"{sign}{hh:02d}{mm:02d}"
    time_text = f"{when.day:02d}/{MONTHS[when.month - 1]}/{when.year}:{when:%H:%M:%S} {zone}"
    method = draw(st.sampled_from(["GET", "POST", "PUT", "DELETE", "HEAD"]))
    path = "/" + draw(token)
    status = draw(st.integers(100, 599))
    size = draw(st.integers(0, 10**9))
    ua = draw(agent)
    line = f'{ip} - - [{time_text}] "{method} {path} HTTP/1.1" {status} {size} "-" "{ua}"'
    offset = dt.timedelta(hours=hh, minutes=mm) * (1 if sign == "+" else -1)
    expected = dict(
        ip=ip,
        timestamp_str=time_text,
        method=method,
        endpoint=path,
        protocol="HTTP/1.1",
        status=status,
        bytes=size,
        user_agent=ua,
        timestamp=when.replace(microsecond=0) - offset,
    )
    return line, expected


@settings(max_examples=1, deadline=None)
@given(st.lists(log_line(), min_size=50, max_size=50))
def test_independent_and_strict_agree(spark, cases):
    rows = [(i, line) for i, (line, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "id int, value string")
    default = {r.id: r.asDict() for r in parse_logs(df, keep=("id",)).collect()}
    strict = {r.id: r.asDict() for r in parse_logs(df, keep=("id",), strict=True).collect()}
    for i, (line, exp) in enumerate(cases):
        for k, v in exp.items():
            assert strict[i][k] == v, (k, line)
            assert default[i][k] == v, (k, line)
