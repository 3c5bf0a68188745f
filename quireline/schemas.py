"""Declared schemas; nothing is inferred."""

from __future__ import annotations

BOX = "struct<x:int,y:int,w:int,h:int>"
IMAGE = "struct<height:int,width:int,nChannels:int,mode:int,data:binary>"
PAGE_RASTER = f"path string, page_no int, image {IMAGE}, error string"
DETECTIONS = "path string, page_no int, det_no int, text string, conf double, left double, top double, width double, height double"
PAGE_METRICS = (
    "path string, page_no int, roi_frac double, blur double, text_density double, core_frac double, skew_deg double, is_table boolean, "
    "conf_med double, conf_mean double, pct80 double, words int, bbox_area_text_frac double, conf_iqr double, line_height_med double, "
    "line_height_var double, line_spacing_med double, line_spacing_var double, text_blocks int, block_w double, block_h double"
)
DOC_QUALITY = (
    "pdf_path string, category string, reason string, avg_blur double, median_ocr_conf double, mean_ocr_conf double, pct80 double, words_count int, "
    "text_density double, roi_frac double, core_frac double, is_table_like boolean, avg_skew_deg double, bbox_area_text_frac double, conf_iqr double, "
    "line_height_med double, line_height_var double, line_spacing_med double, line_spacing_var double, text_blocks_count int, avg_block_width double, "
    "avg_block_height double, error string"
)
DOC_BRIGHTNESS = (
    "pdf_path string, is_dark boolean, mean_brightness double, median_brightness double, dark_pixels_percent double, "
    "very_dark_pixels_percent double, contrast double, reason string, error string"
)
TRAINING = (
    "filename string, true_label string, predicted_label string, reason string, avg_blur double, median_ocr_conf double, mean_ocr_conf double, pct80 double, "
    "words_count int, text_density double, roi_frac double, core_frac double, is_table_like boolean, avg_skew_deg double, bbox_area_text_frac double, "
    "conf_iqr double, line_height_med double, line_height_var double, line_spacing_med double, line_spacing_var double, text_blocks_count int, "
    "avg_block_width double, avg_block_height double, error string, correct int"
)
OCR_RUNS = "filename string, status string, error string, text_len int, raw boolean, ref_len int, cer double"
CER = "filename string, hyp_len int, ref_len int, cer double"
LINE_LOG = f"source_pdf string, page_index int, had_lines boolean, orientation string, score double, num_boxes int, boxes array<{BOX}>, action string"
