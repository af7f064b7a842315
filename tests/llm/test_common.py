from __future__ import annotations

import pyarrow as pa

from tillmark.llm.common import BATCH, per_text


def test_python_gets_long_texts_in_small_batches(spark):
    rows = spark.range(0, 400, 1, 1).selectExpr("id", "repeat('word ', 8000) as text")  # 16 MB in one partition
    found = per_text(rows, "size long", lambda texts: [pa.array([texts.nbytes] * len(texts))]).collect()
    assert len(found) == 400 and max(r.size for r in found) <= BATCH + 50_000
