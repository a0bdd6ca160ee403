"""The declared schemas are the shapes the code produces."""

from conftest import SF_SMALL
from txpulse.operators.anomaly import anomaly_alerts
from txpulse.operators.rfm import rfm_detail, rfm_segments
from txpulse.operators.snapshot import snapshot_from_detail
from txpulse.schemas import ALERT, SEGMENT, SNAPSHOT_ENTRY, SNAPSHOT_HEADER, TRANSACTION
from txpulse.sources.events import events_transactions, orders_transactions
from txpulse.sources.ingest import parse_transactions
from txpulse.sources.kafka import transactions_as_kafka


def _shape(schema):
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def test_transaction_shapes(spark):
    for tx in (
        events_transactions(spark, SF_SMALL),
        orders_transactions(spark, SF_SMALL),
        parse_transactions(transactions_as_kafka(events_transactions(spark, SF_SMALL)))[0],
    ):
        assert _shape(tx.schema) == _shape(TRANSACTION)


def test_output_shapes(spark):
    tx = events_transactions(spark, SF_SMALL)
    assert _shape(anomaly_alerts(tx).schema) == _shape(ALERT)
    assert sorted(_shape(rfm_segments(tx).schema)) == sorted(_shape(SEGMENT))
    headers, entries = snapshot_from_detail(rfm_detail(tx))
    assert sorted(n for n, _ in _shape(headers.schema)) == sorted(SNAPSHOT_HEADER.fieldNames())
    assert _shape(entries.schema) == _shape(SNAPSHOT_ENTRY)
