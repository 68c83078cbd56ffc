"""The row-local cleaning chain gives the same rows on a file stream as in
batch."""

import tempfile

from regmine.operators import clean as E
from regmine.sources.io import write_csv
from regmine.sources.registry import registry_view
from regmine.streaming import start_clean_stream

from conftest import SF_SMALL


def test_stream_equals_batch(spark):
    base = tempfile.mkdtemp(prefix="regmine-stream-")
    src, sink, ck = f"{base}/in", f"{base}/out", f"{base}/ck"
    raw = registry_view(spark, SF_SMALL)
    write_csv(raw, src)
    q = start_clean_stream(spark, src, sink, ck)
    q.awaitTermination(300)
    got = spark.read.parquet(sink)
    want = E.export_products(raw)[1]
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
