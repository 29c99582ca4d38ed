"""The run: .docx files to accepted and rejected questions. Each stage is a table in the run's workspace.

A stage whose table is complete is read, not made again, so a run that stopped goes on with its first incomplete stage.
Calls are kept in the ledger of all runs, so no finished call is sent again. Input, output and workspace are folders that driver and executors share.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmill.functions.text import grade_of, includes_picture, iso_language, language_signs, main_language, static_info, with_default
from quillmill.operators import blocks as B
from quillmill.operators import gates, images, matching, providers, recognition, splitting, understanding
from quillmill.operators.graph import cut
from quillmill.schemas import FINAL_FIELDS
from quillmill.sources import config as C
from quillmill.sources import docx, files, results, runs

STAGES = ("parsed", "blocks", "assets", "recognised", "documents", "questions", "answers", "matches", "outcomes")


@dataclass(frozen=True)
class Summary:
    run_id: str
    output: str
    report: dict


class Workspace:
    """The tables of one run. A table is complete once its writer has committed it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def complete(self, stage: str) -> bool:
        return files.exists(f"{self.folder}/{stage}/_SUCCESS")

    def stage(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        path = f"{self.folder}/{name}"
        if not self.complete(name):
            make().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def first_incomplete(self) -> str | None:
        return next((s for s in STAGES if not self.complete(s)), None)


#: The configured service that takes what a route names.
_SERVICES = {"text_ocr": "text_ocr", "formula": "formula_ocr", "table": "table", "vision_llm": "vision", "keep_vision": "vision", "multimodal": "vision"}


def _recognised(parts: DataFrame, assets: DataFrame, config: C.Config, calibration: DataFrame | None, ledger: providers.Ledger, image_models: DataFrame | None) -> tuple[DataFrame | None, DataFrame | None]:
    """Settled contents of image blocks and of previews of embedded objects, each by the service that its class of image goes to.

    Previews are of formulas. A service that is not configured is not asked, and without a calibration none is trusted.
    """
    if calibration is None:
        return None, None
    shown = parts.where("type IN ('image', 'unresolved') AND asset_id IS NOT NULL").join(images.classified(assets, image_models), "asset_id")
    service = F.create_map(*[F.lit(x) for pair in _SERVICES.items() for x in pair])[recognition.route(F.col("image_class"))]
    asked = shown.select("block_id", F.when(F.col("type") == "unresolved", "formula_ocr").otherwise(service).alias("task"), F.coalesce("is_critical", F.lit(True)).alias("is_critical"), "content")
    settled, calls = None, None
    for name in sorted(set(_SERVICES.values())):
        primary = C.provider(config, name, "primary")
        if primary is not None:
            one, made = providers.recognised(asked.where(F.col("task") == name), primary, C.provider(config, name, "fallback"), calibration, ledger, config.concurrency[name])
            settled, calls = (one, made) if settled is None else (settled.unionByName(one), calls.unionByName(made))
    return settled, calls


def _resolved(parts: DataFrame, settled: DataFrame) -> DataFrame:
    """The blocks, with those embedded objects as formulas whose preview a service has read and the ladder accepts."""
    read = settled.where("action = 'accept' AND trim(content) <> ''").select("block_id", F.col("content").alias("_read"))
    joined = parts.join(read, "block_id", "left")
    told = (F.col("type") == "unresolved") & F.col("_read").isNotNull()
    return joined.withColumns({"latex": F.when(told, F.regexp_replace("_read", r"^\s*\$+|\$+\s*$", "")).otherwise(F.col("latex")), "type": F.when(told, "formula").otherwise(F.col("type"))}).drop("_read")


def _documents(parsed: DataFrame, parts: DataFrame) -> DataFrame:
    """A row for each document: file, status, class, numbers, fields, cluster."""
    names = parsed.select("document_id", "source_file", "status")
    values = understanding.metadata_values(names, parts)
    fields = understanding.wide(understanding.prioritised(values, "document_id"), "document_id")
    title = parts.where("type = 'paragraph' AND raw_text <> ''").groupBy("document_id").agg(F.min_by("raw_text", "ord").alias("title"))
    made = names.join(understanding.classify(understanding.features(parts)), "document_id", "left").join(title, "document_id", "left").join(fields, "document_id", "left")
    none = F.array().cast("array<string>")
    made = made.withColumns({"document_class": F.coalesce("document_class", F.lit("UNKNOWN")), "question_numbers": F.coalesce("question_numbers", none), "answer_numbers": F.coalesce("answer_numbers", none)})
    signs = {k: F.sum(v) for k, v in language_signs(F.col("raw_text")).items()}
    spoken = parts.where("type NOT IN ('formula', 'unresolved')").groupBy("document_id").agg(main_language(signs).alias("document_language"))
    made = made.join(spoken, "document_id", "left").withColumn("own_fields", F.array(*understanding.FIELDS))
    placed = understanding.clusters(made)
    lent = understanding.wide(understanding.prioritised(understanding.from_cluster(values, placed), "document_id"), "document_id")
    return made.drop(*understanding.FIELDS).join(placed, "document_id").join(lent, "document_id", "left")


def _sides(parts: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(blocks of questions, blocks of answers), by the class of the document and its heading of answers."""
    marked = understanding.sections(parts).join(documents.select("document_id", "document_class"), "document_id")
    inline = F.coalesce(F.col("raw_text").rlike(r"【答案】|^\s*答案\s*[:：]|^\s*【解析】|^\s*解析\s*[:：]"), F.lit(False))
    kind = F.col("document_class")
    answers = (kind == "ANSWER") | ((kind == "QUESTION_AND_ANSWER") & F.col("in_answers")) | ((kind == "MIXED") & inline)
    # an answer that stands under its question has that question's number
    own = splitting.question_number(F.col("resolved_label"), F.col("raw_text"))
    last = F.last(own, ignorenulls=True).over(W.partitionBy("document_id").orderBy("ord"))
    marked = marked.withColumns({"_answer": answers, "_number": last})
    numbered = F.when((kind == "MIXED") & own.isNull(), F.concat("_number", F.lit(". "), "raw_text")).when(F.col("resolved_label").isNotNull(), F.concat_ws(" ", "resolved_label", "raw_text")).otherwise(F.col("raw_text"))
    return marked.where(~F.col("_answer") & (kind != "UNKNOWN")), marked.where("_answer").withColumn("raw_text", numbered)


def _bounded(work: Workspace, side: DataFrame, config: C.Config, ledger: providers.Ledger) -> DataFrame:
    """Candidates by rules; in documents where these are unsure, by a model's boundaries, if one is configured and all of them can be taken."""
    found = splitting.split_questions(side)
    model = C.provider(config, "llm", "primary")
    if model is None:
        return found
    line = F.lit(config.quality["split_accept"]).cast("decimal(9,6)")
    body = side.where(~F.col("type").isin("header", "footer", "noise_candidate")).join(found.where(F.col("split_score") < line).select("document_id").distinct(), "document_id", "left_semi")
    asked = body.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct("ord", "block_id", "raw_text"))).alias("b")).select("document_id", F.transform("b", lambda x: F.struct(x["block_id"].alias("block_id"), x["raw_text"].alias("raw_text"))).alias("blocks"))
    told, calls = providers.boundaries(asked, model, ledger, C.prompt("question_split"), "question_split/v1", config.concurrency["llm"])
    calls.write.mode("overwrite").parquet(f"{work.folder}/calls_split")
    return splitting.chosen_boundaries(found, told, side)


def _questions(parts: DataFrame, assets: DataFrame, settled: DataFrame | None, documents: DataFrame, side: DataFrame, found: DataFrame) -> DataFrame:
    """Candidates with their text, laid out from the source's blocks, and what is wrong with the blocks."""
    each = found.select("question_candidate_id", F.posexplode("content_blocks").alias("ord", "block_id"))
    kinds = assets.select("asset_id", "ext", F.lit(True).alias("there"))
    shown = each.join(parts.drop("ord", "document_id"), "block_id").join(kinds, "asset_id", "left")
    if settled is None:
        shown = shown.withColumns({"content": F.lit(None).cast("string"), "action": F.lit(None).cast("string")})
    else:
        shown = shown.join(settled.select("block_id", "content", "action"), "block_id", "left")
    text = B.rendered(F.col("type"), F.col("raw_text"), F.col("latex"), F.col("asset_id"), F.col("ext"))
    # blocks of one paragraph are one line: a formula inside a sentence stays in it
    before = F.lag("para").over(W.partitionBy("question_candidate_id").orderBy("ord"))
    laid = shown.select("question_candidate_id", "ord", F.concat(F.when(before == F.col("para"), "").otherwise("\n"), F.coalesce(text, F.lit(""))).alias("shown"))
    texts = B.joined_in_order(laid, "question_candidate_id", F.col("shown"), "").select("question_candidate_id", F.expr("substring(text, 2)").alias("text_question"))
    image = F.col("type") == "image"
    state = shown.groupBy("question_candidate_id").agg(
        F.bool_or(image & F.col("there").isNull()).alias("image_missing"), F.bool_or((F.col("type") == "unresolved") | ((F.col("type") == "formula") & F.col("latex").isNull())).alias("unresolved"), F.bool_or(image & (F.col("action") == "reject")).alias("unread"),
    )
    sound = gates.block_gate(parts, assets).select("document_id", "stable")
    placed = documents.select("document_id", "cluster_id", "source_file", "status").join(sound, "document_id")
    lost = gates.ownership_gate(found, side).join(side.select("block_id", "document_id"), "block_id").select("document_id", F.lit(True).alias("lost")).distinct()
    return found.join(texts, "question_candidate_id").join(state, "question_candidate_id").join(placed, "document_id").join(lost, "document_id", "left")


def _matches(questions: DataFrame, answers: DataFrame, documents: DataFrame) -> DataFrame:
    """(question_candidate_id, answer_candidate_id, top1, top2): the best answer in the question's cluster, by all evidence.

    What has less than half of the evidence is no candidate.
    """
    about = documents.select("document_id", understanding.exam_key(F.col("source_file")).alias("file"), F.col("own_fields").alias("fields"))
    side = lambda df, key: df.join(about, "document_id").select("*", F.col("document_id").alias("document"), F.col("question_number").cast("int").alias("number"), F.col(key).alias("id"))
    q = side(questions, "question_candidate_id").select("*", F.struct("document_id", "place").alias("ord"), F.col("question_type_candidate").alias("kind"), F.col("text_question").alias("stem"))
    a = side(answers, "answer_candidate_id").withColumn("ord", F.struct("document_id", "place"))
    found = matching.signals(q, a, aligned=cut(matching.weighed(q, a)))
    scored = found.select("q", "a", matching.evidence_score({k: F.col(k) for k in matching.WEIGHTS}, F.col("conflict")).alias("score"))
    return matching.top_two(scored.where(F.col("score") >= F.lit("0.5").cast("decimal(9,6)")), "q", "a", "score").withColumnsRenamed({"q": "question_candidate_id", "a": "answer_candidate_id"})


def _outcomes(questions: DataFrame, answers: DataFrame, matched: DataFrame, checked: DataFrame, documents: DataFrame, config: C.Config) -> DataFrame:
    """Every candidate with its final fields, lineage, and the stage and reason of its earliest failing gate."""
    t = config.quality
    said = answers.select("answer_candidate_id", F.col("answer").alias("text_answer"), F.col("analysis").alias("answer_analysis"), F.col("document_id").alias("answer_document_id"), F.col("source_blocks").alias("answer_blocks"))
    about = documents.select("document_id", "title", "document_language", *understanding.FIELDS)
    df = questions.join(matched, "question_candidate_id", "left").join(checked, ["question_candidate_id", "answer_candidate_id"], "left").join(said, "answer_candidate_id", "left").join(about, "document_id", "left")
    # a question without words of its own is in its document's language
    language = F.coalesce(main_language(language_signs(F.regexp_replace("text_question", r"\$[^$]*\$|<[^>]*>", " "))), "document_language")
    made = {
        "text_course": F.col("course"), "text_grade_level": F.col("level"), "text_grade": grade_of(F.col("level")), "text_paper": F.col("title"), "text_year": F.col("year"), "text_city": F.col("city"), "entrance_exam_type": F.col("exam"),
        "question_type": F.col("question_type_candidate"), "language": iso_language(language), "is_pic_included": includes_picture(F.col("text_question")),
        "static_info": static_info(F.col("text_question"), copyright=F.lit(config.output["copyright_default"]), source_files=F.array("source_file"), source_question_blocks=F.col("content_blocks"), source_answer_blocks=F.col("answer_blocks"), pipeline_version=F.lit(config.pipeline_version)),
    }
    df = df.withColumns(made)
    absent = {f: F.lit(None).cast("string") for f in FINAL_FIELDS if f not in df.columns}
    df = df.withColumns(absent)
    df = df.withColumns({f: with_default(F.col(f), f) for f, default in FINAL_FIELDS.items() if default is not None})
    decision = matching.abstention(F.col("top1"), F.col("top2"), F.col("verifier_score"), F.col("verdict"), t["answer_match_accept"], t["answer_match_margin"], t["answer_verify_accept"])
    d = lambda v: F.lit(v).cast("decimal(9,6)")
    return gates.outcome(df, [
        *gates.file_gate(F.col("status")), ("ir", "DOCUMENT_RELATION_BROKEN", ~F.col("stable")),
        ("recognition", "IMAGE_MISSING", F.col("image_missing")), ("recognition", "FORMULA_UNRESOLVED", F.col("unresolved")), ("recognition", "OCR_LOW_CONFIDENCE", F.coalesce("unread", F.lit(False))),
        ("split", "QUESTION_SPLIT_LOW_CONFIDENCE", F.col("split_score") < d(t["split_accept"])), ("split", "QUESTION_SPLIT_LOW_CONFIDENCE", F.coalesce("lost", F.lit(False))), ("split", "QUESTION_CONTENT_INCOMPLETE", F.trim("text_question") == ""),
        *[("match", code, decision == code) for code in ("ANSWER_NOT_FOUND", "ANSWER_MATCH_AMBIGUOUS", "ANSWER_VERIFICATION_FAILED")],
        *gates.contract_failures(),
    ])


def run(spark: SparkSession, source: str, output: str, config: C.Config, calibration: DataFrame | None = None, ledger: DataFrame | None = None, image_models: DataFrame | None = None) -> Summary:
    """Make questions, rejections, images and the report of all .docx files below `source`.

    The run's id follows from the inputs, the configuration and the version, so the same call goes on with the same run. A
    changed threshold is another run. Without a verifier no answer is accepted. All runs of an output keep one ledger of
    calls, which is read before any call and written before anything else is made of one, so a run that stops or
    has another threshold sends no finished call again. `ledger` has calls of elsewhere. `image_models` are those of images.fit; without them ruling lines and lines of text tell the class of an image.
    """
    began = time.monotonic()
    files.ship(spark)
    given = spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").option("recursiveFileLookup", "true").load(source)
    run_id = runs.fingerprint(given.select(F.sha2("content", 256).alias("source_sha256")), config.digest, config.pipeline_version)[:16]
    work = Workspace(spark, f"{output}/workspace/{run_id}")
    ledger = providers.Ledger(spark, f"{output}/workspace/ledger", ledger)
    results.write_json({"run_id": run_id, "source": source, "config_digest": config.digest, "quality": config.quality, "pipeline_version": config.pipeline_version}, f"{work.folder}/run.json")

    whole = work.stage("parsed", lambda: docx.read_docx(spark, source))
    parsed = whole.join(whole.groupBy("document_id").agg(F.min("source_file").alias("source_file")), ["document_id", "source_file"], "left_semi").dropDuplicates(["document_id"])
    parts = work.stage("blocks", lambda: B.noise_candidates(docx.blocks(parsed)))
    assets = work.stage("assets", lambda: docx.assets(parsed))
    settled, calls = (None, None) if work.complete("recognised") else _recognised(parts, assets, config, calibration, ledger, image_models)
    empty = "block_id string, content string, normalized_score decimal(9,6), action string"
    if calls is not None:
        calls.write.mode("overwrite").parquet(f"{work.folder}/calls_recognition")
    settled = work.stage("recognised", lambda: spark.createDataFrame([], empty) if settled is None else settled)
    parts = _resolved(parts, settled)
    documents = work.stage("documents", lambda: _documents(parsed, parts))
    asked, told = _sides(parts, documents)
    questions = work.stage("questions", lambda: _questions(parts, assets, settled, documents, asked, _bounded(work, asked, config, ledger)))
    extracted = splitting.extract_answers(told)
    supported = lambda: extracted.join(splitting.unsupported(extracted, parts).select("answer_candidate_id"), "answer_candidate_id", "left_anti").join(documents.select("document_id", "cluster_id"), "document_id")
    answers = work.stage("answers", supported)
    matched = work.stage("matches", lambda: _matches(questions, answers, documents))
    if not work.complete("verdicts"):
        _verified(work, questions, answers, matched, config, ledger)
    checked = spark.read.parquet(f"{work.folder}/verdicts")
    outcomes = work.stage("outcomes", lambda: _outcomes(questions, answers, matched, checked, documents, config))

    good = gates.accepted(outcomes)
    for name, rows in (("questions.jsonl", good.select(*FINAL_FIELDS)), ("rejected.jsonl", gates.rejected(outcomes, F.col("question_candidate_id"), F.array("source_file"), F.to_json(F.struct("top1", "top2", "verdict"))).unionByName(_unreadable(parsed)))):
        if not files.exists(f"{output}/{run_id}/{name}/_SUCCESS"):
            rows.write.option("ignoreNullFields", "false").mode("overwrite").json(f"{output}/{run_id}/{name}")
    results.write_images(assets, good, f"{output}/{run_id}/image")
    ledgers = [spark.read.parquet(f"{work.folder}/{n}") for n in ("calls_recognition", "calls_split", "calls_verify") if work.complete(n)]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ledgers) if ledgers else None
    meta = {"run_id": run_id, "pipeline_version": config.pipeline_version, "config_digest": config.digest}
    told_ = results.run_report(outcomes, parsed.count(), every, time.monotonic() - began, meta)
    results.write_json(told_, f"{output}/{run_id}/run_report.json")
    return Summary(run_id, f"{output}/{run_id}", told_)


def _verified(work: Workspace, questions: DataFrame, answers: DataFrame, matched: DataFrame, config: C.Config, ledger: providers.Ledger) -> None:
    """Ask the verifier about the pairs that pass the score and margin alone; others need no call."""
    t, verifier = config.quality, C.provider(config, "llm", "verifier")
    d = lambda v: F.lit(v).cast("decimal(9,6)")
    if verifier is None:
        work.stage("verdicts", lambda: work.spark.createDataFrame([], "question_candidate_id string, answer_candidate_id string, verdict string, verifier_score decimal(9,6), reason string, cache_key string"))
        return
    sure = matched.where((F.col("top1") >= d(t["answer_match_accept"])) & (F.col("top1") - F.col("top2") >= d(t["answer_match_margin"])))
    pairs = sure.join(questions.select("question_candidate_id", F.col("text_question").alias("question"), "content_blocks"), "question_candidate_id").join(answers.select("answer_candidate_id", "answer", "source_blocks"), "answer_candidate_id")
    pairs = pairs.select(F.col("question_candidate_id").alias("question_id"), F.col("answer_candidate_id").alias("answer_id"), "question", "answer", F.concat("content_blocks", "source_blocks").alias("block_ids"))
    found, calls = providers.verdicts(pairs, verifier, ledger, C.prompt("answer_verify"), "answer_verify/v1", config.concurrency["llm"])
    calls.write.mode("overwrite").parquet(f"{work.folder}/calls_verify")
    work.stage("verdicts", lambda: found.withColumnsRenamed({"question_id": "question_candidate_id", "answer_id": "answer_candidate_id"}))


def _unreadable(parsed: DataFrame) -> DataFrame:
    """Rejections of files that could not be read; they have no candidates."""
    bad = parsed.where("status = 'parse_failed'")
    return gates.rejected(bad.withColumns({"stage": F.lit("file"), "reason_code": F.lit("DOCUMENT_PARSE_FAILED")}), F.col("document_id"), F.array("source_file"))


def trace(spark: SparkSession, workspace: str, candidate: str) -> DataFrame:
    """The blocks behind one candidate: (side, block_id, document_id, source_file, raw_text, latex, asset_id)."""
    outcomes = spark.read.parquet(f"{workspace}/outcomes").where(F.col("question_candidate_id") == candidate)
    sides = outcomes.select(F.explode(F.array(F.struct(F.lit("question").alias("side"), F.col("content_blocks").alias("ids")), F.struct(F.lit("answer").alias("side"), F.col("answer_blocks").alias("ids")))).alias("s")).select("s.side", F.explode("s.ids").alias("block_id"))
    parts = spark.read.parquet(f"{workspace}/blocks").select("block_id", "document_id", "ord", "raw_text", "latex", "asset_id")
    return sides.join(parts, "block_id").join(spark.read.parquet(f"{workspace}/documents").select("document_id", "source_file"), "document_id").select("side", "block_id", "document_id", "source_file", "ord", "raw_text", "latex", "asset_id")


def lineage(spark: SparkSession, workspace: str) -> DataFrame:
    """(source, target, kind): what everything in a run rests on, as edges between typed names such as candidate:x, block:y, call:z.

    candidates rest on blocks, answers (of which the match is one) and the verifier's call; answers on blocks; blocks on documents; documents on
    files; calls on the provider, model and prompt; and each candidate on the run's configuration. graph.reached walks them,
    either way round: from a question to all that it rests on, or from a file or a model to all questions that rest on it.
    """
    table = lambda name: spark.read.parquet(f"{workspace}/{name}")
    named = lambda kind, c: F.concat(F.lit(f"{kind}:"), c)
    edge = lambda df, source, target, kind: df.select(source.alias("source"), target.alias("target"), F.lit(kind).alias("kind")).where("source IS NOT NULL AND target IS NOT NULL")
    outcomes, told = table("outcomes"), json.loads(files.read(f"{workspace}/run.json"))
    candidate, answer = named("candidate", F.col("question_candidate_id")), named("answer", F.col("answer_candidate_id"))
    each = lambda of, blocks: outcomes.select(of.alias("of"), F.explode(blocks).alias("block"))
    calls = [table(n) for n in ("calls_recognition", "calls_split", "calls_verify") if files.exists(f"{workspace}/{n}/_SUCCESS")]
    edges = [
        edge(each(candidate, "content_blocks"), F.col("of"), named("block", F.col("block")), "question"), edge(each(answer, "answer_blocks"), F.col("of"), named("block", F.col("block")), "answer"), edge(outcomes, candidate, answer, "match"),
        edge(outcomes, candidate, named("call", F.col("cache_key")), "verdict"),
        edge(table("blocks"), named("block", F.col("block_id")), named("document", F.col("document_id")), "source"), edge(table("documents"), named("document", F.col("document_id")), named("file", F.col("source_file")), "source"),
        edge(outcomes, candidate, F.lit(f"configuration:{told['config_digest']}"), "configuration"),
        *[edge(c, named("call", F.col("cache_key")), named("model", F.concat_ws("/", "provider", "model", "prompt_version")), "service") for c in calls],
    ]
    return reduce(DataFrame.unionByName, edges).distinct()
