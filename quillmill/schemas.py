"""Record layouts and closed sets of values."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the record contract.
BLOCK_TYPES = ("paragraph", "formula", "image", "table", "textbox", "header", "footer", "noise_candidate", "unresolved")
DOCUMENT_CLASSES = ("QUESTION", "ANSWER", "QUESTION_AND_ANSWER", "MIXED", "UNKNOWN")
IMAGE_CLASSES = ("TEXT_IMAGE", "FORMULA_IMAGE", "TABLE_IMAGE", "QUESTION_SCREENSHOT", "DIAGRAM", "GEOMETRY", "CHART", "MAP", "CHEMISTRY", "MIXED", "UNKNOWN")
STATES = ("PENDING", "RUNNING", "COMPLETED", "FAILED", "REJECTED")
REJECT_CODES = (
    "DOCUMENT_PARSE_FAILED", "DOCUMENT_RELATION_BROKEN", "QUESTION_SPLIT_LOW_CONFIDENCE", "QUESTION_CONTENT_INCOMPLETE", "OCR_LOW_CONFIDENCE", "FORMULA_UNRESOLVED", "TABLE_UNRESOLVED",
    "IMAGE_MISSING", "ANSWER_NOT_FOUND", "ANSWER_MATCH_AMBIGUOUS", "ANSWER_VERIFICATION_FAILED", "LANGUAGE_UNRESOLVED", "SCHEMA_VALIDATION_FAILED",
)
COURSES = ("语文", "数学", "英语", "科学", "政治", "历史", "地理", "物理", "化学", "生物", "未知")
GRADE_LEVELS = tuple(f"小学{n}年级" for n in "一二三四五六") + tuple(f"{s}{n}年级" for s in ("初中", "高中") for n in "一二三") + ("未知",)
GRADES = ("小学", "初中", "高中", "未知")
ENTRANCE_EXAMS = ("小升初", "中考", "高考", "未知")
QUESTION_TYPES = ("判断题", "选择题", "填空题", "问答题", "其他题型", "未知")

#: The final contract, in order: required fields and what an absent value becomes (None: the record is rejected).
FINAL_FIELDS = {
    "text_question": None, "is_pic_included": None, "text_answer": None, "answer_analysis": "略", "text_course": "未知", "text_grade_level": "未知", "text_grade": "未知", "knowledge_points": "", "exam_points": "",
    "publisher": "", "text_paper": "未知", "textbook_version": "", "static_info": None, "language": None, "text_year": "", "entrance_exam_type": "未知", "text_city": "", "question_type": "未知", "competition_event": "",
}
FINAL = T.StructType([T.StructField(name, T.IntegerType() if name == "is_pic_included" else T.StringType()) for name in FINAL_FIELDS])
ENUMS = {"text_course": COURSES, "text_grade_level": GRADE_LEVELS, "text_grade": GRADES, "entrance_exam_type": ENTRANCE_EXAMS, "question_type": QUESTION_TYPES}

SCORE = "decimal(9,6)"
BLOCKS = "document_id string, block_id string, ord int, type string, raw_text string, normalized_text string, style_id string, resolved_label string, source_type string, latex string, asset_id string, is_critical boolean"
ASSETS = "document_id string, asset_id string, sha256 string, ext string, content binary"
REJECTED = "candidate_id string, stage string, reason_code string, details string, source_files array<string>"
CALLS = "provider string, model string, request_id string, prompt_version string, latency double, tokens bigint, cost double, raw_score decimal(9,6), normalized_score decimal(9,6), fallback_reason string"
