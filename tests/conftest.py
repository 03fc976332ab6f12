import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerlens.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="ledgerlens-tests")
    yield s
    s.stop()


# Mini logs of FIXTURES.md section 2 (raw text columns, as read from CSV).
OPS = [
    ("u1", "3", "A", "08:10:00"), ("u1", "3", "A", "08:10:00"), ("u1", "3", "B", "08:20:00"),
    ("u1", "3", "B", "09:00:00"), ("u1", "21", "A", "00:30:00"), ("u2", "10", "A", "12:59:59"),
    ("u2", "11", "", "13:00:00"), ("u3", "20", "C", "19:00:00"),
]
TRANS = [
    ("u1", "ch", "3", "08:20:00", "1000.0", "T1", "x"),
    ("u1", "ch", "3", "23:59:59", "100.0", "T2", "x"),
    ("u1", "ch", "5", "10:00:00", "10000.0", "T1", "x"),
    ("u1", "ch", "5", "10:00:01", "250.0", "T1", "x"),
    ("u4", "ch", "31", "14:30:00", "20000.0", "T2", "x"),
]
TAGS = [("u1", "1"), ("u2", "0"), ("u3", "0"), ("u4", "1")]


@pytest.fixture(scope="session")
def mini(spark):
    from ledgerlens.operators import preprocess
    from ledgerlens.sources import raw

    raw_ops = spark.createDataFrame(OPS, "uid string, day string, mode string, time string")
    raw_trans = spark.createDataFrame(
        TRANS, "uid string, channel string, day string, time string, trans_amt string, "
               "trans_type1 string, trans_type2 string")
    tags = spark.createDataFrame(TAGS, "uid string, tag string")
    op_base = preprocess.slim_operations(raw_ops)
    trans_base = preprocess.slim_transactions(raw_trans)
    labels = preprocess.labels_or_default(raw.labels_from_tags(tags), op_base, trans_base)
    return dict(raw_ops=raw_ops, raw_trans=raw_trans, op_base=op_base, trans_base=trans_base,
                labels=labels)
