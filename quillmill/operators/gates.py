"""Ordered quality gates: every candidate is accepted, or rejected with the reason of its earliest failing gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions.text import grade_of, slim_md5
from quillmill.schemas import ENUMS, FINAL_FIELDS

Gate = tuple[str, str, Column]  # stage, reason code, condition of failure


def outcome(df: DataFrame, gates: list[Gate]) -> DataFrame:
    """df with stage and reason_code of the first gate that fails; both null where none does. An unknown condition fails."""
    if not gates:
        return df.withColumns({"stage": F.lit(None).cast("string"), "reason_code": F.lit(None).cast("string")})
    fails = [(stage, code, F.coalesce(condition, F.lit(True))) for stage, code, condition in gates]
    first = F.coalesce(*[F.when(c, F.struct(F.lit(s).alias("stage"), F.lit(r).alias("reason_code"))) for s, r, c in fails])
    made = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), first.alias("gate"))
    return made.select(*[F.col("row").getField(c).alias(c) for c in df.columns if c not in ("stage", "reason_code")], "gate.stage", "gate.reason_code")


def accepted(df: DataFrame) -> DataFrame:
    return df.where("reason_code IS NULL").drop("stage", "reason_code")


def rejected(df: DataFrame, candidate: Column, files: Column | None = None, details: Column | None = None) -> DataFrame:
    files = F.array().cast("array<string>") if files is None else files
    return df.where("reason_code IS NOT NULL").select(candidate.cast("string").alias("candidate_id"), "stage", "reason_code", (F.lit("{}") if details is None else details).alias("details"), files.alias("source_files"))


def file_gate(status: Column) -> list[Gate]:
    return [("file", "DOCUMENT_PARSE_FAILED", status == "parse_failed"), ("file", "DOCUMENT_RELATION_BROKEN", status == "relation_broken")]


def block_gate(blocks: DataFrame, assets: DataFrame) -> DataFrame:
    """(document_id, stable, images_there): whether block order is whole and every image has its asset."""
    known = assets.select("asset_id").distinct().withColumn("known", F.lit(True))
    return blocks.join(known, "asset_id", "left").groupBy("document_id").agg(
        ((F.count("*") == F.max("ord") + 1) & (F.count_distinct("ord") == F.count("*"))).alias("stable"),
        F.bool_and(~(F.col("type") == "image") | F.coalesce("known", F.lit(False))).alias("images_there"),
    )


def ownership_gate(candidates: DataFrame, blocks: DataFrame) -> DataFrame:
    """(block_id, problem): critical blocks of no candidate, and blocks of more than one."""
    owned = candidates.select(F.explode("content_blocks").alias("block_id"))
    twice = owned.groupBy("block_id").agg(F.count("*").alias("n")).where("n > 1").select("block_id", F.lit("owned twice").alias("problem"))
    lost = blocks.where("is_critical").select("block_id").join(owned, "block_id", "left_anti").select("block_id", F.lit("not owned").alias("problem"))
    return twice.unionByName(lost)


def contract_failures() -> list[Gate]:
    """Gates of the final record: required fields, listed values, consistent grade, language, static information."""
    out: list[Gate] = [("contract", "LANGUAGE_UNRESOLVED", F.col("language").isNull() | ~F.col("language").rlike("^[a-z]{2}$"))]
    bad = F.lit(False)
    for name, default in FINAL_FIELDS.items():
        bad = bad | F.col(name).isNull()
        if default is None and name not in ("is_pic_included", "language"):
            bad = bad | (F.trim(F.col(name)) == "")
    for name, values in ENUMS.items():
        bad = bad | ~F.col(name).isin(*values)
    bad = bad | ~F.col("is_pic_included").isin(0, 1) | (F.col("text_grade") != grade_of(F.col("text_grade_level")))
    parsed = F.try_parse_json("static_info").isNull() | ~F.get_json_object("static_info", "$.slim_question_md5").eqNullSafe(slim_md5(F.col("text_question")))
    return [*out, ("contract", "SCHEMA_VALIDATION_FAILED", bad | parsed)]
