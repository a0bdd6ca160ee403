"""Malformed payloads: what is kept, what is quarantined and why."""

from txpulse.sources.ingest import parse_transactions, parse_typed_transactions

PAYLOADS = [
    ('{"user_id":1,"type":"Credit","sum":10.5,"event_time":1700000000000}', None),
    ("not json", "null_user_id"),
    ('{"type":"Credit"}', "null_user_id"),
    ('{"user_id":2,"type":"Credit","event_time":5}', "null_sum"),
    ('{"user_id":"x","sum":1}', "null_user_id"),
    ('{"user_id":3,"sum":"7","type":"Deposit","event_time":1,"extra":9}', "null_sum"),
    ('{"user_id":4,"sum":7,"type":1,"event_time":1.5}', "null_event_time"),
    ('{"user_id":5.0,"sum":7}', "null_user_id"),
    (None, "null_value"),
    ('[{"user_id":6,"sum":1}]', "null_user_id"),
    ('{"user_id":99999999999,"sum":1}', "null_user_id"),
    ('{"User_Id":8,"sum":1}', "null_user_id"),
    ('{"user_id":9,"type":null,"sum":2.5,"event_time":7}', None),  # null type is kept
]


def _wire(spark, values):
    rows = [(None if v is None else bytearray(v.encode()), i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "value binary, offset long").selectExpr(
        "cast(null as binary) as key", "value", "'t' as topic", "0 as partition", "offset",
        "cast(null as timestamp) as timestamp", "0 as timestampType",
    )


def test_parse_routes_every_payload(spark):
    clean, rejects = parse_transactions(_wire(spark, [p for p, _ in PAYLOADS]))
    got = {r["offset"]: r["reason"] for r in rejects.collect()}
    for i, (_, reason) in enumerate(PAYLOADS):
        assert got.get(i) == reason, PAYLOADS[i]
    c = {r["seq"]: r for r in clean.collect()}
    assert sorted(c) == [0, 12]
    assert (c[0]["user_id"], c[0]["type"], c[0]["sum"], c[0]["event_time"]) == (1, "Credit", 10.5, 1700000000000)
    assert c[12]["type"] is None


def test_typed_reading_is_strict_on_type_and_exact_on_amount(spark):
    values = [
        '{"user_id":1,"type":"Credit","sum":10.25}',
        '{"user_id":2,"type":"credit","sum":1}',
        '{"user_id":3,"type":"Deposit","sum":"7.10"}',
        '{"user_id":4,"type":"Deposit"}',
        '{"user_id":5,"type":"Deposit","sum":10.555}',
        '{"user_id":6,"type":"Deposit","sum":1e17}',
    ]
    ok, bad = parse_typed_transactions(_wire(spark, values))
    assert {r["user_id"]: str(r["sum"]) for r in ok.collect()} == {1: "10.25", 3: "7.10"}
    assert ok.schema["sum"].dataType.simpleString() == "decimal(18,2)"
    assert {r["offset"]: r["reason"] for r in bad.collect()} == {
        1: "bad_type",
        3: "null_sum",
        4: "bad_sum_precision",
        5: "bad_sum_precision",
    }
