import pytest
from fragstat.functions.decode import decode_csv, encode_csv
from fragstat.schemas import KILLS, nullable
from fragstat.sources.topic import decode_events

SMALL = "a int, b string, c double"


def decode_one(spark, payload, schema=SMALL, **kw):
    df = spark.createDataFrame([(payload,)], "value string")
    from pyspark.sql.types import _parse_datatype_string
    return decode_csv(df, _parse_datatype_string(schema), **kw).collect()


@pytest.mark.parametrize("payload, expected", [
    ("1,x,2.5", (1, "x", 2.5)),          # plain
    ("1,x", (1, "x", None)),              # too few fields: tail NULL
    ("1,x,2.5,extra,more", (1, "x", 2.5)),  # too many: dropped
    ("x,y,z", (None, "y", None)),         # unparsable numbers: NULL, row kept
    ("True,y,1", (None, "y", 1.0)),
    ("1.0,y,1", (None, "y", 1.0)),        # 1.0 is not an INT
    (",,", (None, None, None)),           # empty fields: NULL, strings too
    ("", (None, None, None)),             # empty payload: all-NULL row
    (None, (None, None, None)),           # NULL payload: all-NULL row
    ('1,"a,b",3', (1, "a,b", 3.0)),       # quoted comma
    (" 1 , s , 2 ", (None, " s ", 2.0)),  # padded INT does not parse, DOUBLE is trimmed,
                                          # strings keep their spaces
    ("a,b,c", (None, "b", None)),         # header line is not skipped
])
def test_decode_table(spark, payload, expected):
    rows = decode_one(spark, payload)
    assert len(rows) == 1 and tuple(rows[0]) == expected


def test_decode_keeps_every_field_nullable(spark):
    df = spark.createDataFrame([("1,2,3",)], "value string")
    out = decode_csv(df, KILLS)
    assert all(f.nullable for f in out.schema.fields)
    assert out.columns == KILLS.fieldNames()


def test_binary_payload_and_kept_columns(spark):
    df = spark.createDataFrame([(bytearray(b"7,8,9"), "game.kills")], "value binary, topic string")
    out = decode_events(df, "kills", keep=("topic",)).first()
    assert (out.topic, out.frame, out.tick, out["round"]) == ("game.kills", 7, 8, 9)


def test_damage_decode_adds_damage_dealt(spark):
    line = "1,2,3,,,100,55" + "," * 16
    out = decode_events(spark.createDataFrame([(line,)], "value string"), "damages").first()
    assert out.damage_dealt == 45 and out.victim_health == 100


def test_quarantine_column(spark):
    df = spark.createDataFrame([("1,x,2.5",), ("bad,x,1",), ("2,y",)], "value string")
    from pyspark.sql.types import _parse_datatype_string
    rows = decode_csv(df, _parse_datatype_string(SMALL), corrupt_col="_bad").orderBy("b", "a").collect()
    bad = {r.b: r._bad for r in rows}
    assert bad["x"] in (None, "bad,x,1") and bad["y"] == "2,y"
    assert [r._bad for r in rows if r.a == 1] == [None]


def test_encode_decode_round_trip(spark):
    schema = nullable(KILLS)
    names = schema.fieldNames()
    tricky = ["plain", "with,comma", 'with "quote"', "line\nbreak", "  outer  ", None]
    rows = []
    for i, s in enumerate(tricky):
        r = [None] * len(names)
        r[names.index("frame")] = i
        r[names.index("killer_name")] = s
        r[names.index("killer_steamid")] = 76561198000000000 + i
        r[names.index("distance")] = 1.0 / 3 if i else 1e300
        rows.append(tuple(r))
    src = spark.createDataFrame(rows, schema)
    payload = src.select(encode_csv(names).alias("value"))
    back = decode_csv(payload, schema)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, src.collect()), key=repr)


def test_empty_string_comes_back_null(spark):
    src = spark.createDataFrame([(1, "")], "a int, b string")
    back = decode_csv(src.select(encode_csv(["a", "b"]).alias("value")), src.schema).first()
    assert back.b is None
