"""Row types of the records that pass between operators (Spark DDL)."""

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"
REGION = "region_id string, row_off int, col_off int, width int, height int"
REGION_INDEX = REGION + ", ordinal int"
TREE_RESULT = REGION + ", method string, has_tree boolean, score double, vegetation_fraction double, texture_score double, tree_coverage double, reason string, processed_at string"
TILE = "tile_id string, region_id string, row_off int, col_off int, width int, height int, vegetation_fraction double, texture_score double, score double"
DETECTION = f"struct<label:string,score:double,reason:string,tile_px_bbox:{BOX},orig_px_bbox:{BOX},source_crs:string,source_crs_polygon:array<array<double>>,wgs84_polygon:array<array<double>>>"
TILE_RESULT = TILE + f", status string, image_path string, detections array<{DETECTION}>, processed_at string"
SAMPLE = "sample_key string, stage string, item_id string, width int, height int, path string, saved_at string"
ANNOTATION_TASK = (
    "id bigint, data struct<image:string>, annotations array<struct<updated_at:string,created_at:string,was_cancelled:boolean,"
    "result:array<struct<type:string,original_width:int,original_height:int,"
    "value:struct<x:double,y:double,width:double,height:double,rectanglelabels:array<string>>>>>>"
)
