"""The envelope against a literal reading of its layout, edge cases first."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import envelope, sequence
from tidelog.schema import SEQUENCE_HEADER, SHARD_HEADER

MESSAGE = T.StructType(
    [
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("payload", T.BinaryType()),
    ]
)


def packed(spark, *messages):
    rows = spark.createDataFrame(list(messages), MESSAGE)
    return [bytes(r[0]) for r in rows.select(envelope.pack(F.col("headers"), F.col("payload"))).collect()]


def unpacked(spark, *data):
    rows = spark.createDataFrame([(d,) for d in data], "data binary")
    rows = rows.withColumn("n", envelope.block_length(F.col("data")))
    out = rows.select(
        envelope.unpack_headers(F.col("data"), F.col("n")),
        envelope.unpack_payload(F.col("data"), F.col("n")),
    )
    return [(r[0], bytes(r[1])) for r in out.collect()]


def literal(data):
    """Straight from the layout; Python's universal trimming is close to Unicode White_Space."""
    if data[:4] == b"RSK1" and len(data) >= 8:
        n = int.from_bytes(data[4:8], "big")
        if len(data) >= 8 + n:
            headers = {}
            for line in data[8 : 8 + n].decode("utf-8", "replace").split("\n"):
                name, colon, value = line.partition(":")
                if colon:
                    headers[name.strip(envelope.WHITE_SPACE)] = value.strip(envelope.WHITE_SPACE)
            return headers, data[8 + n :]
    return {}, data


def block(text, payload=b"p"):
    return b"RSK1" + len(text).to_bytes(4, "big") + text + payload


def test_only_user_headers_make_an_envelope(spark):
    plain, keyed, tagged, empty = packed(
        spark,
        ({}, b"raw"),
        ({"partition-key": "user-42"}, b"raw"),
        ({"partition-key": "user-42", "x-tenant": "acme"}, b"raw"),
        (None, None),
    )
    assert plain == keyed == b"raw"
    assert empty == b""
    assert tagged == block(b"x-tenant: acme\n", b"raw")
    assert unpacked(spark, tagged) == [({"x-tenant": "acme"}, b"raw")]


def test_plain_payload_reads_as_headerless(spark):
    assert unpacked(spark, b'{"id":1}') == [({}, b'{"id":1}')]


def test_edge_cases_of_decoding(spark):
    cases = [
        b"",
        b"RSK1",
        b"RSK1\x00\x00\x00",
        b"RSK1\x00\x00\x00\x00",
        b"RSK1\x00\x00\x00\x01",
        b"RSK1\xff\xff\xff\xffrest",
        block(b""),
        block(b"no colon\n"),
        block(b"A: 1\nA: 2\n"),
        block(b"A: 1\r\nB:2\r\n"),
        block(b"\t A \x0b:  b: c \t\n"),
        block(" A :　x\u0085\n".encode()),
        block(b"A: \xff\xfe\n"),
        block(b"A: \xe2\x82\n\xf0\x9f\x98:x"),
        block(b": no name\nA:\n"),
        block(b"A: x\ninjected: y\n"),
        b"rsk1\x00\x00\x00\x00",
    ]
    assert unpacked(spark, *cases) == [literal(c) for c in cases]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.dictionaries(st.text(max_size=4), st.text(max_size=6), max_size=3),
            st.binary(max_size=12),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_what_is_packed_decodes_as_the_layout_says(spark, messages):
    clean = [
        ({k.encode("utf-8", "replace").decode(): v.encode("utf-8", "replace").decode() for k, v in h.items()}, p)
        for h, p in messages
    ]
    data = packed(spark, *clean)
    assert unpacked(spark, *data) == [literal(d) for d in data]


def test_many_headers_in_one_record(spark):
    text = "".join(f"h{i % 3000}: {i}\n" for i in range(6000)).encode()
    [(headers, payload)] = unpacked(spark, block(text))
    assert payload == b"p"
    assert headers == {f"h{i}": str(i + 3000) for i in range(3000)}


def test_aggregated_marker_needs_more_than_four_bytes(spark):
    magic = b"\xf3\x89\x9a\xc2"
    rows = spark.createDataFrame([(magic,), (magic + b"x",), (b"x" + magic,)], "data binary")
    flags = rows.select(envelope.is_aggregated(F.col("data"))).collect()
    assert [f[0] for f in flags] == [False, True, False]


def test_reserved_headers_come_from_the_record(spark):
    row = spark.range(1).select(
        envelope.delivered_headers(
            F.map_entries(F.create_map(F.lit(SHARD_HEADER), F.lit("forged"), F.lit("a"), F.lit("1"))),
            F.lit("k"), F.lit("7"), F.lit("s1"),
        ).alias("h")
    ).first()
    assert row.h == {"a": "1", "partition-key": "k", SEQUENCE_HEADER: "7", SHARD_HEADER: "s1"}


def test_order_keys_sort_like_numbers(spark):
    numbers = ["0", "7", "10", "007", "4" * 56, "9" * 128, "1" + "0" * 128]
    rows = spark.createDataFrame([(n,) for n in numbers], "n string").select(
        "n", sequence.order_key(F.col("n")).alias("k"), sequence.padded_key(F.col("n")).alias("p")
    ).collect()
    assert [r.n for r in sorted(rows, key=lambda r: (r.k, r.n))] == sorted(numbers, key=lambda n: (int(n), n))
    assert [r.n for r in sorted(rows, key=lambda r: (r.p, r.n))] == sorted(numbers, key=lambda n: (int(n), n))
    assert len(rows[-1].p) == 129


def test_long_sequences_are_refused_and_not_shortened(spark):
    for key in (sequence.order_key, sequence.padded_key):
        fits = spark.createDataFrame([("0" * 50 + "9" * 129,)], "n string").select(key(F.col("n"))).first()[0]
        assert fits.endswith("9" * 129)
        with pytest.raises(Exception, match="more than 129 digits"):
            spark.createDataFrame([("1" * 130,)], "n string").select(key(F.col("n"))).collect()
