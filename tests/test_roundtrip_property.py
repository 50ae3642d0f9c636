"""Property: a row encoded as a CSV payload decodes back to the same row.

Strings draw from an alphabet with the CSV-special characters (separator,
quote, escape, newline, outer spaces).  The empty string is the one value
that does not survive (it comes back NULL), as documented.
"""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fragstat.functions.decode import decode_csv, encode_csv

SCHEMA = "a int, b string, c bigint, d double, e string"

text = st.text(alphabet=st.sampled_from(list('ab ,"\\\n\'x;')), min_size=1, max_size=8)
rows = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(-2**31, 2**31 - 1)),
        st.one_of(st.none(), text),
        st.one_of(st.none(), st.integers(-2**63, 2**63 - 1)),
        st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False, width=64)),
        st.one_of(st.none(), text),
    ),
    min_size=1,
    max_size=30,
)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_encode_decode_identity(spark, batch):
    src = spark.createDataFrame(batch, SCHEMA)
    payload = src.select(encode_csv(src.columns).alias("value"))
    back = decode_csv(payload, src.schema)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, src.collect()), key=repr)
