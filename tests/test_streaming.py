import numpy as np
from pyspark.sql import functions as F

from harrier.operators.detect import bright_spots
from harrier.streaming.arrivals import detect_arrivals, watch
from test_sources import tiff


def test_arrivals(spark, tmp_path):
    folder, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    scene = np.zeros((3, 64, 64), np.uint8)
    scene[:, 16:32, 16:32] = 255

    def arrive(name, raw):
        (tmp_path / "in" / name).write_bytes(raw)
        query = detect_arrivals(watch(spark, folder), bright_spots, out, state)
        query.awaitTermination()
        assert query.exception() is None
        return spark.read.parquet(out).agg(F.countDistinct("image_id")).first()[0]

    assert arrive("a.tif", tiff(scene)) == 1
    assert arrive("b.tif", b"broken") == 1
    assert arrive("c.TIFF", tiff(scene, ">")) == 2
