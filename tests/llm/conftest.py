import binascii

import pytest


def fold(doc_id, n):
    return binascii.crc32(str(doc_id).encode()) % n


@pytest.fixture(scope="session")
def rows_of(spark):
    """Rows (doc_id, text, ...) as a frame over a few partitions."""

    def make(rows, schema="doc_id long, text string", parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make
