"""Explicit schemas of the inputs (Spark DDL); nothing is inferred from files."""

SIGNALS = "subject_id string, session_id string, series string, sample_idx bigint, v array<float>"
SERIES_META = "subject_id string, session_id string, series string, rate double, t0 double, channel_ids array<int>, gains array<double>, offsets array<double>"
TTL_EVENTS = "subject_id string, session_id string, channel int, sample bigint, state int"
VIDEO_FRAMES = "path string, frame_idx int, t_s double"
CS_FRAMES = "subject_id string, first_cs_frame int"
SESSION_TYPES = "session_key string, description string, name string, environment string, camera_id array<int>, task_epochs array<int>"
DEVICES = "task string, name string, description string, manufacturer string"
ELECTRODE_GROUPS = "location_code string, group_name string, description string, location string, targeted_location string, targeted_x double, targeted_y double, targeted_z double, units string"
PROJECT = "observations map<string,struct<`time offset`:double,media_info:struct<fps:map<string,double>>,events:array<array<string>>>>, behaviors_conf map<string,struct<type:string,code:string,description:string>>"
