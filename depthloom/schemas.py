"""Schemas of the long tables and of the 13 relational tables."""

from __future__ import annotations

FRAMES = "split string, i int, name string, w int, h int, k array<array<double>>, img string, depth string"
POINTS = "frame string, seq long, x double, y double, z double, r smallint, g smallint, b smallint"
PIXELS = "frame string, v int, u int, z double"
VOXELS = "frame string, ix long, iy long, iz long, sem int, observed boolean"
BOXES = "frame string, j int, cls string, centroid array<double>, coeffs array<double>, basis array<array<double>>, bb2d array<double>, rtilt array<array<double>>"
MANIFEST = "key string, file string, count long, bytes long, md5 string, median_depth double"

TABLES = {
    "attribute": "token string, name string, description string",
    "calibrated_sensor": "token string, sensor_token string, camera_intrinsic array<array<double>>, rotation array<double>, translation array<double>",
    "category": "token string, name string, description string",
    "ego_pose": "token string, timestamp long, rotation array<double>, translation array<double>",
    "instance": "token string, category_token string, nbr_annotations int, first_annotation_token string, last_annotation_token string",
    "log": "token string, logfile string, vehicle string, date_captured string, location string",
    "map": "token string, category string, filename string, log_tokens array<string>",
    "sample": "token string, timestamp long, prev string, next string, scene_token string",
    "sample_annotation": "token string, sample_token string, instance_token string, attribute_token string, translation array<double>, size array<double>, "
    "rotation array<double>, prev string, next string, num_lidar_pts long, num_radar_pts int",
    "sample_data": "token string, sample_token string, ego_pose_token string, calibrated_sensor_token string, timestamp long, fileformat string, is_key_frame boolean, "
    "height int, width int, filename string, prev string, next string, sensor_modality string",
    "scene": "token string, log_token string, nbr_samples long, first_sample_token string, last_sample_token string, name string, description string",
    "sensor": "token string, channel string, modality string",
    "visibility": "token string, level string, description string",
}
