"""Schemas of scene folders and question files."""

from __future__ import annotations

POINTS = "ARRAY<STRUCT<x: DOUBLE, y: DOUBLE, z: DOUBLE>>"
LABEL = f"STRUCT<ins_id: STRING, id: STRING, label: STRING, bounding_box: {POINTS}>"
OUTLINE = "ARRAY<ARRAY<DOUBLE>>"
ROOM = f"STRUCT<profile: {OUTLINE}, polygon: {OUTLINE}, floor: {OUTLINE}, boundary: {OUTLINE}>"
WALL = f"STRUCT<location: {OUTLINE}, thickness: DOUBLE, height: DOUBLE>"
STRUCTURE = f"rooms ARRAY<{ROOM}>, walls ARRAY<{WALL}>"
OCCUPANCY = "min ARRAY<DOUBLE>, lower ARRAY<DOUBLE>, max ARRAY<DOUBLE>, upper ARRAY<DOUBLE>, center ARRAY<DOUBLE>"
OBJECT = "STRUCT<id: STRING, label: STRING, center: ARRAY<DOUBLE>, dims: ARRAY<DOUBLE>, aabb_min: ARRAY<DOUBLE>, aabb_max: ARRAY<DOUBLE>, room_index: INT, volume: DOUBLE>"
POSE = "STRUCT<position: ARRAY<DOUBLE>, target: ARRAY<DOUBLE>, yaw: DOUBLE, pitch: DOUBLE, radius: DOUBLE, target_objects: ARRAY<STRING>>"
QUESTION = (
    "question STRING, answer STRING, answer_type STRING, question_type STRING, question_id STRING, primary_object STRING, scene_id STRING, "
    f"camera_pose_idx INT, objects ARRAY<{OBJECT}>, camera_pose {POSE}, choices MAP<STRING, STRING>, answer_text STRING, answer_value DOUBLE, "
    "mc_source_type STRING, room STRING, camera_yaw DOUBLE, image STRING, image_path STRING"
)
METADATA = "scene_id STRING, pattern STRING, num_cameras INT, num_questions INT, focus_objects ARRAY<STRING>, num_focus_objects INT, num_focus_pairs INT, question_types ARRAY<STRING>"
