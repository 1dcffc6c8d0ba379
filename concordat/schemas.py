"""Explicit read schemas; nothing is inferred and absent fields read as null."""

LICENCE_ENTRY = (
    "struct<license:struct<id:string,name:string,"
    "text:struct<contentType:string,encoding:string,content:string>>,expression:string>"
)
COMPONENT = (
    "struct<name:string,version:string,purl:string,copyright:string,"
    f"licenses:array<{LICENCE_ENTRY}>,"
    "properties:array<struct<name:string,value:string>>,"
    "externalReferences:array<struct<type:string,url:string>>>"
)
METADATA = "struct<tools:array<struct<vendor:string,name:string,version:string>>>"
HEAD = f"bomFormat string, specVersion string, metadata {METADATA}"  # an inventory but for its components

CURATION_VALUE = "struct<rationale:string,classification:string>"
TOOL_VALUE = (
    "struct<source_tarball:string,tarball_root_prefix:string,"
    "license_files_in_tarball:array<string>,primary_license_id:string,"
    "notice_files_in_tarball:array<string>,copyright_seed:array<string>,rationale:string>"
)
SCAN_FILE = (
    "path string, type string, detected_license_expression_spdx string, "
    "license_detections array<struct<matches:array<struct<license_expression_spdx:string,score:double>>>>"
)
RELEASE_HASHES = (
    "tag string, app_id string, depot_id string, raw_buildid string, generated_at string, generator string, "
    "files array<struct<filename:string,sha256:string,size:bigint>>, "
    "composite_buildid string, live_branch string, set_live_at string, depot_manifests map<string,string>"
)
AV_DOCUMENT = (
    "tag string, filename string, sha256 string, vt_link string, fetched_at string, "
    "last_analysis_stats map<string,bigint>, "
    "last_analysis_results map<string,struct<method:string,engine_name:string,engine_version:string,"
    "engine_update:string,category:string,result:string>>"
)
LANDED_FILE = "key string, content binary"
EXTRACTED = "key string, prefix string, kind string, ord bigint, rel_path string, content binary, message string"
