from __future__ import annotations

import numpy as np

from depthloom.sources import codecs, datasource


def test_formats(spark, tmp_path):
    datasource.register(spark)
    (tmp_path / "a").mkdir()
    for k in (1, 2):
        (tmp_path / "a" / f"{k}.pcd.bin").write_bytes(codecs.encode_bin(np.full((k, 3), float(k)), np.zeros((k, 3), np.uint8)))
    (tmp_path / "m.ply").write_bytes(codecs.encode_ply(np.zeros((3, 3)), np.full((3, 3), 5, np.uint8)))
    sem, mask = np.full((4, 4, 4), 17, np.uint8), np.zeros((4, 4, 4), np.uint8)
    sem[1, 2, 3], mask[1, 2, 3] = 9, 1
    (tmp_path / "o.npz").write_bytes(codecs.encode_npz(semantics=sem, mask_lidar=mask, mask_camera=mask))
    points = spark.read.format("pointbin").load(str(tmp_path))
    assert points.count() == 3 and points.where("x = 2").count() == 2
    assert spark.read.format("plymesh").load(str(tmp_path)).where("red = 5").count() == 3
    assert [tuple(r)[1:] for r in spark.read.format("occupancy").load(str(tmp_path)).collect()] == [(1, 2, 3, 9)]
    assert spark.read.format("mat5").option("variable", "x").load(str(tmp_path)).count() == 0
