"""Hand vectors: event_time = BASE + offset (ms); expected values per row."""

from pyspark.sql import functions as F

BASE = 1_700_000_000_000
DAY = 86_400_000

# user, offset, seq, type, sum, expected prior_n, expected prior avg, alert?
ANOMALY = [
    (1, 0, 1, "Deposit", 100.0, 0, 0.0, False),
    (1, 60_000, 2, "Credit", 299.99, 1, 100.0, False),
    (1, 120_000, 3, "cReDiT", 600.0, 2, 199.995, True),
    (1, 300_000, 4, "Credit", 1000.0, 3, 333.33, True),
    (1, 300_000, 5, "Deposit", 9000.0, 4, 499.9975, False),
    (1, 330_000, 6, None, 1.0, 4, 2724.9975, False),
    (2, 0, 7, "Deposit", 100.0, 0, 0.0, False),
    (2, 300_001, 8, "Credit", 1000.0, 0, 0.0, False),
    (3, 0, 9, "Deposit", -5.0, 0, 0.0, False),
    (3, 1, 10, "Credit", 10.0, 1, -5.0, False),
]

NEW, VIP, ACTIVE, SLEEP, STD = "Новичок", "VIP", "Активный", "Спящий", "Стандартный"

# user, offset, seq, type, sum, f, m, segment (reference thresholds, retention 7 d)
RFM = [
    (1, 0, 1, "Deposit", 2000.0, 1, 2000.0, NEW),
    (1, 299_999, 2, "Credit", 5.0, 2, 2000.0, NEW),
    (1, 300_000, 3, "Deposit", 1.0, 3, 2001.0, ACTIVE),
    (1, 400_000, 4, "Deposit", 4000.0, 4, 6001.0, ACTIVE),
    (1, 500_000, 5, "Deposit", 4000.0, 5, 10001.0, ACTIVE),
    (1, 600_000, 6, "Credit", 1.0, 6, 10001.0, VIP),
    (1, DAY, 7, "Credit", 1.0, 7, 10001.0, VIP),
    (1, DAY + 1, 8, "Credit", 1.0, 7, 8001.0, ACTIVE),
    (2, 0, 9, "Deposit", 1000.0, 1, 1000.0, NEW),
    (2, 300_000, 10, "Credit", 1.0, 2, 1000.0, STD),
    (2, 300_000 + 604_799_999, 11, "Credit", 1.0, 1, 0.0, STD),
    (2, 300_000 + 604_799_999 + 604_800_000, 12, "Credit", 1.0, 1, 0.0, NEW),
]


def frame(spark, rows):
    data = [(u, t, BASE + off, seq, s) for (u, off, seq, t, s, *_rest) in rows]
    return spark.createDataFrame(data, "user_id int, type string, event_time long, seq long, sum double").select(
        "user_id", "type", "sum", "event_time", "seq"
    )


def shuffled(df):
    return df.orderBy(F.rand(7))
