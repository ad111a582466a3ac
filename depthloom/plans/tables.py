"""The relational scene model: 13 tables from the frames, as joins and windows over one frame table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depthloom import schemas
from depthloom.functions.geometry import token
from depthloom.functions.rotations import rounded
from depthloom.operators import chain
from depthloom.operators.detection import CLASSES

# First timestamp and step in microseconds, cameras by image size, the camera's axis quaternion.
END = "EOF"
FIRST_STAMP, STAMP_STEP = 1532402927647951, 33000
CAMERAS = {(730, 530): "kv2", (591, 441): "xtion", (561, 427): "kv1", (681, 531): "realsense"}
CAMERA_AXES = [0.5, -0.5, 0.5, -0.5]


def _literals(spark: SparkSession, name: str, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, schemas.TABLES[name])


def _doubles(values: list[float]):  # noqa: ANN202
    return F.array(*[F.lit(float(v)) for v in values])


def build(frames: DataFrame, dataset: str = "sunrgbd") -> dict[str, DataFrame]:
    """Tables of one split from frames (split, i, name, w, h, k). An image size without a camera is an error."""
    spark = frames.sparkSession
    camera = F.lit(None).cast("string")
    for (w, h), name in CAMERAS.items():
        camera = F.when((F.col("w") == w) & (F.col("h") == h), name).otherwise(camera)
    f = frames.withColumn("camera", F.coalesce(camera, F.raise_error(F.concat(F.lit("no camera for "), F.col("w").cast("string"), F.lit("x"), F.col("h").cast("string")))))
    f = f.withColumns({"scene_token": token("scene", F.col("split"), F.col("camera")), "token": token("sample", F.col("split"), F.col("name")), "timestamp": (F.lit(FIRST_STAMP) + F.col("i") * STAMP_STEP).cast("long")})
    f = f.withColumn("kk", rounded("k", F.lit(4)))
    flat = F.flatten("kk")
    said = F.concat(F.lit("("), F.array_join(F.transform(flat, lambda v: v.cast("string")), ", "), F.lit(")"))
    f = f.withColumns({"calibrated": token("calib:native", said), "cam": token("sd", F.col("split"), F.col("name"), "cam"), "lid": token("sd", F.col("split"), F.col("name"), "lid")})
    linked = chain.linked(f, "scene_token", ["name"], end="")
    first = chain.first_per_key(f.withColumn("place", F.struct("camera", "name")), [F.col("calibrated")], "k", ["place"])
    empty, lidar = F.lit(""), token("calib:LIDAR_TOP")
    data = [
        ("cam", F.col("calibrated"), "jpg", F.col("h"), F.col("w"), F.concat(F.lit("samples/CAM_FRONT/"), "split", F.lit("/"), "name", F.lit(".jpg")), "camera"),
        ("lid", lidar, "pcd.bin", F.lit(0), F.lit(0), F.concat(F.lit("samples/LIDAR_TOP/"), "split", F.lit("/"), "name", F.lit(".pcd.bin")), "lidar"),
    ]
    sample_data, ego = None, None
    for key, cal, fmt, h, w, file, kind in data:
        one = f.select(
            F.col(key).alias("token"), F.col("token").alias("sample_token"), F.col(key).alias("ego_pose_token"), cal.alias("calibrated_sensor_token"), "timestamp", F.lit(fmt).alias("fileformat"), F.lit(True).alias("is_key_frame"),
            h.cast("int").alias("height"), w.cast("int").alias("width"), file.alias("filename"), empty.alias("prev"), empty.alias("next"), F.lit(kind).alias("sensor_modality"),
        )
        pose = f.select(F.col(key).alias("token"), "timestamp", _doubles([1, 0, 0, 0]).alias("rotation"), _doubles([0, 0, 0]).alias("translation"))
        sample_data, ego = (one, pose) if sample_data is None else (sample_data.union(one), ego.union(pose))
    scenes = chain.scene_rollup(f.withColumn("log_token", token("log", F.col("split"), F.col("camera"))), "scene_token", ["name"])
    names = f.groupBy("scene_token").agg(F.first("split").alias("split"), F.first("camera").alias("camera"))
    logs = names.select(token("log", F.col("split"), F.col("camera")).alias("token"), F.concat_ws("-", F.lit(dataset), "split", "camera").alias("logfile"), F.col("camera").alias("vehicle"), F.lit("2014-01-01").alias("date_captured"), F.lit("indoor").alias("location"))
    calibrated = first.select(F.col("calibrated").alias("token"), token("sensor:CAM_FRONT").alias("sensor_token"), F.col("k").alias("camera_intrinsic"), _doubles(CAMERA_AXES).alias("rotation"), _doubles([0, 0, 0]).alias("translation"))
    lidar_row = spark.range(1).select(lidar.alias("token"), token("sensor:LIDAR_TOP").alias("sensor_token"), F.array().cast("array<array<double>>").alias("camera_intrinsic"), _doubles([1, 0, 0, 0]).alias("rotation"), _doubles([0, 0, 0]).alias("translation"))
    fixed = lambda rows, cols: spark.createDataFrame(rows, cols)
    return {
        "sensor": fixed([("CAM_FRONT", "camera"), ("LIDAR_TOP", "lidar")], "channel string, modality string").select(token("sensor", F.col("channel")).alias("token"), "channel", "modality"),
        "log": logs,
        "sample": linked.select("token", "timestamp", "prev", "next", "scene_token"),
        "calibrated_sensor": calibrated.union(lidar_row),
        "sample_data": sample_data,
        "ego_pose": ego,
        "scene": scenes.join(names, "scene_token").select(
            F.col("scene_token").alias("token"), token("log", F.col("split"), F.col("camera")).alias("log_token"), "nbr_samples", "first_sample_token", "last_sample_token", F.concat_ws("-", F.lit(dataset), "split", "camera").alias("name"),
            F.concat(F.lit(dataset), F.lit(" "), "split", F.lit(" ("), "camera", F.lit(")")).alias("description"),
        ),
        "category": fixed([(c,) for c in CLASSES], "c string").select(F.md5(F.concat(F.lit("cat/"), "c")).alias("token"), F.concat("c", F.lit(".indoor")).alias("name"), F.col("c").alias("description")),
        "map": logs.agg(F.array_sort(F.collect_list("token")).alias("log_tokens")).select(F.md5(F.lit("map/train")).alias("token"), F.lit("indoor").alias("category"), F.lit("").alias("filename"), "log_tokens"),
        "visibility": spark.range(1, 5).select(F.md5(F.concat(F.lit("vis/"), F.col("id").cast("string"))).alias("token"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("level"), F.lit("stub").alias("description")),
        "attribute": _literals(spark, "attribute", []),
    }


def annotations(tasks: DataFrame) -> DataFrame:
    """A row for each frame of the occupancy annotations: scene, token, entry fields with chain ends EOF.

    tasks: scene, token, ts, fx, fy, cx, cy, img, and nullable ego_pose and extrinsic.
    """
    linked = chain.linked(tasks, "scene", ["ts", "token"])
    row = lambda *v: F.array(*[x.cast("double") if not isinstance(x, float) else F.lit(x) for x in v])
    k = F.array(row(F.col("fx"), 0.0, F.col("cx")), row(0.0, F.col("fy"), F.col("cy")), row(0.0, 0.0, 1.0))
    path = F.concat(F.lit("gts/"), "scene", F.lit("/"), "token", F.lit("/labels.npz"))
    return linked.select("scene", "token", "split", F.col("ts").alias("timestamp"), path.alias("gt_path"), "prev", "next", k.alias("intrinsics"), F.coalesce("img", F.lit("")).alias("img_path"))
