"""The stateless cleaners on a file stream."""

import os
import tempfile

from catalink.streaming.cleaning import clean_stream, read_text_stream, write_stream_once


def test_clean_stream_available_now(spark):
    folder = tempfile.mkdtemp(prefix="catalink-stream-in-")
    with open(os.path.join(folder, "part-0.csv"), "w", encoding="utf-8") as f:
        f.write('app_id,price,name\n1,999,"A \\"quote\\""\n2,N, b \n 3 ,1499,c\n')
    stream = read_text_stream(spark, folder, ["app_id", "price", "name"])
    assert stream.isStreaming
    cleaned = clean_stream(stream, longs=["app_id"], prices=["price"])
    out_dir = tempfile.mkdtemp(prefix="catalink-stream-out-")
    write_stream_once(cleaned, out_dir, checkpoint=tempfile.mkdtemp(prefix="catalink-stream-ckpt-"))
    rows = sorted(tuple(r) for r in spark.read.parquet(out_dir).collect())
    assert rows == [(1, 9.99, 'A "quote"'), (2, None, "b"), (3, 14.99, "c")]
