"""Blocks to questions, and blocks to answers, by rules; nothing is written that the source does not say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmill.operators.blocks import islands
from quillmill.schemas import SCORE

_NUMBER = r"^\s*(\d{1,3})\s*[.．、)）](?!\d)"
_ANSWER = r"^\s*(\d{1,3})\s*[.．、)）](?!\d)\s*(?:【答案】|答案[:：])?\s*(.+)$"
_ANALYSIS_MARK = r"^\s*(【解析】|【分析】|解析[:：])"
#: A heading of a part of an exam, after which numbers may begin again.
_PART = r"^\s*(?:第\s*[一二三四五六七八九十\dIVXⅠⅡⅢ]+\s*[卷部]|[一二三四五六七八九十]{1,3}\s*[、.．].{0,20}题)"
_HEADING = r"^\s*【?(参考)?答案(与|及|和)?(解析)?】?\s*[:：]?\s*$"
_ANALYSIS = r"(?s)^(.*?)(?:【解析】|【分析】|解析[:：])(.*)$"


def question_number(label: Column, text: Column) -> Column:
    """The number that begins a block: of its list label, else of its text; else null. Subquestions have none."""
    of = lambda c: F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), _NUMBER, 1), F.lit(""))
    return F.coalesce(of(label), of(text))


#: What the heading of a part says of the questions in it.
_PART_KINDS = (("选择", "选择题"), ("填空", "填空题"), ("判断", "判断题"), ("解答|问答|计算|简答|证明", "问答题"))


def split_questions(blocks: DataFrame) -> DataFrame:
    """(question_candidate_id, document_id, content_blocks, question_number, question_type_candidate, split_score, place).

    A numbered block at the outer level begins a question; subquestions, options and shared pieces stay with it.
    Headers, footers, noise and the headings of parts belong to none; a heading tells the type where the question itself does not.
    Blocks before the first number are of no question. A number that neither follows the one before it nor counts from the
    beginning of its part, or that stands twice, scores below the accept line. `place` orders the questions of a document.
    """
    body = blocks.where(~F.col("type").isin("header", "footer", "noise_candidate")).withColumn("number", question_number(F.col("resolved_label"), F.col("raw_text")))
    along = W.partitionBy("document_id").orderBy("ord").rowsBetween(W.unboundedPreceding, 0)
    heading = F.coalesce(F.col("raw_text").rlike(_PART), F.lit(False)) & F.col("number").isNull()
    body = body.withColumn("part", F.last(F.when(heading, F.struct(F.col("ord").alias("at"), F.col("raw_text").alias("head"))), ignorenulls=True).over(along)).where(~heading)
    return _candidates(islands(body, "document_id", ["ord"], F.col("number").isNotNull()).where("island > 0")).drop("unresolved")


def _candidates(runs: DataFrame) -> DataFrame:
    """The candidates of blocks with number, part and island, as split_questions gives them, and whether one has an unresolved block."""
    option = F.col("raw_text").rlike(r"(?m)(^|\s)A\s*[.．、].*\bB\s*[.．、]|(^|\s)[A-D]\s*[.．、]")
    found = runs.groupBy("document_id", "island").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("ord", "block_id"))), lambda b: b["block_id"]).alias("content_blocks"), F.min_by("number", "ord").alias("question_number"), F.bool_or(F.coalesce(option, F.lit(False))).alias("options"), F.bool_or(F.coalesce(F.col("raw_text").rlike("_{3,}|（\\s*）"), F.lit(False))).alias("blank"), F.bool_or(F.col("type") == "unresolved").alias("unresolved"),
        F.min("ord").alias("begins"), F.min_by("part", "ord").alias("part"),
    )
    in_part = F.row_number().over(W.partitionBy("document_id", "part.at").orderBy("island"))
    follows = F.col("question_number").cast("int").isin(F.col("island"), in_part)
    told = F.coalesce(*[F.when(F.col("part.head").rlike(pattern), F.lit(name)) for pattern, name in _PART_KINDS], F.lit("未知"))
    kind = F.when(F.col("options"), "选择题").when(F.col("blank"), "填空题").otherwise(told)
    score = F.when(F.col("unresolved"), "0.90").when(follows, "0.99").otherwise("0.95").cast(SCORE)
    name = F.lpad(F.col("island").cast("string"), F.greatest(F.lit(4), F.length(F.col("island").cast("string"))), F.lit("0"))
    return found.select(F.concat_ws("_q", "document_id", name).alias("question_candidate_id"), "document_id", "content_blocks", "question_number", kind.alias("question_type_candidate"), score.alias("split_score"), F.struct("begins", F.lit(0).alias("at")).alias("place"), "unresolved")


#: Lines that a task sorts by document, on average at most.
LINES = 250_000


def extract_answers(blocks: DataFrame, ahead: int = 50) -> DataFrame:
    """(answer_candidate_id, document_id, question_number, answer, analysis, source_blocks, place) from numbered lines.

    Compact lists (`1. A 2. B`), one answer a line, and answers with an analysis. An answer goes on over the lines and
    blocks after it up to the next number or a heading of answers; an analysis that repeats its answer's number goes
    with it. A number begins an answer only where it can follow: not before a digit (a decimal), not below a number that stands
    before it in the same part of the exam, and not more than `ahead` above the count of numbers there; else the line
    goes on. Parts begin at headings, after which numbers may begin again. Without an analysis it is 略; an analysis
    without an answer before it gives none. `place` (block's ord, line) orders the answers of a document.
    """
    compact = F.regexp_extract_all(F.col("raw_text"), F.lit(r"(\d{1,3}\s*[.．、)）]\s*[A-D]+)(?=\s|$|[,，;；])"), F.lit(1))
    lines = F.when(F.size(compact) > 1, compact).otherwise(F.split("raw_text", "\n"))
    each = blocks.where("raw_text IS NOT NULL AND type NOT IN ('header', 'footer', 'noise_candidate')").select("document_id", "block_id", "ord", F.posexplode(lines).alias("at", "line"))
    # all windows below are by document: as many tasks as there are lines for, so that what one sorts does not grow with the table
    tasks = max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-each.count() // LINES))
    each = each.repartition(tasks, "document_id")
    told, rest = F.nullif(F.regexp_extract("line", _ANSWER, 1), F.lit("")), F.regexp_extract("line", _ANSWER, 2)
    order = W.partitionBy("document_id").orderBy("ord", "at")
    heading = F.col("line").rlike(_HEADING) | F.col("line").rlike(_PART)
    parts = each.withColumns({"told": told, "part": F.sum(heading.cast("long")).over(order)})
    within = W.partitionBy("document_id", "part").orderBy("ord", "at")
    value = F.col("told").cast("int")
    parts = parts.withColumn("value", F.when(value <= F.count("told").over(within) + ahead, value))
    highest = F.max("value").over(within.rowsBetween(W.unboundedPreceding, -1))
    numbered = parts.withColumns({"highest": highest, "number": F.when((F.col("value") > highest) | highest.isNull() | ((F.col("value") == highest) & rest.rlike(_ANALYSIS_MARK)), F.col("told"))})
    marked = numbered.withColumn("again", F.coalesce(F.col("value") == F.col("highest"), F.lit(False)))
    runs = islands(marked, "document_id", ["ord", "at"], (F.col("number").isNotNull() & ~F.col("again")) | heading)
    said = F.when(F.col("number").isNotNull(), rest).otherwise(F.col("line"))
    pieces = F.array_sort(F.collect_list(F.struct("ord", "at", "block_id", said.alias("said"))))
    whole = runs.where("island > 0").groupBy("document_id", "island").agg(pieces.alias("p"), F.min_by("number", F.struct("ord", "at")).alias("question_number")).where("question_number IS NOT NULL")
    whole = whole.select("document_id", "question_number", "p", F.array_join("p.said", "\n").alias("rest"))
    split = F.col("rest").rlike(_ANALYSIS)
    head, tail = F.regexp_extract("rest", _ANALYSIS, 1), F.regexp_extract("rest", _ANALYSIS, 2)
    bare = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    out = whole.select("*", bare(F.when(split, head).otherwise(F.col("rest"))).alias("answer"), F.coalesce(F.nullif(bare(F.when(split, tail)), F.lit("")), F.lit("略")).alias("analysis"))
    return out.where("answer <> ''").select(F.expr("concat_ws('_a', p[0].block_id, p[0].at)").alias("answer_candidate_id"), "document_id", "question_number", "answer", "analysis", F.array_distinct("p.block_id").alias("source_blocks"), F.expr("struct(p[0].ord, p[0].at)").alias("place"))


def unsupported(answers: DataFrame, blocks: DataFrame, cited: str = "source_blocks") -> DataFrame:
    """The answers that their cited blocks, put together in the order cited, do not hold, or that cite a block that is not there."""
    each = answers.select("answer_candidate_id", F.col("answer").alias("wanted"), F.posexplode_outer(cited).alias("at", "block_id"))
    bare = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", "")
    seen = each.join(blocks.select("block_id", "raw_text"), "block_id", "left")
    told = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", bare(F.col("raw_text")).alias("t")))), lambda x: x["t"]), "")
    held = seen.groupBy("answer_candidate_id", "wanted").agg(told.alias("told"), F.bool_and(F.col("raw_text").isNotNull()).alias("there")).withColumn("held", F.contains("told", bare(F.col("wanted"))))
    return answers.join(held.where("NOT (held AND there)"), "answer_candidate_id", "left_semi")


def interval_faults(proposals: DataFrame, blocks: DataFrame) -> DataFrame:
    """(document_id, proposal_id, block_id, problem): what keeps proposed questions, intervals of block ids, from being taken.

    proposals are (document_id, proposal_id, first, last), blocks (document_id, block_id, ord, is_critical). A proposal is `unknown block` if
    an end is no block of its document, `reversed` if its last block stands before its first, and `overlap` if it begins
    no later than one before it ends, by the order of the source. A critical block in no proposal is `not covered`. All
    is found by one sweep over each document's blocks and ends; block_id is null for proposals, proposal_id for blocks.
    """
    place = lambda name: blocks.select("document_id", F.col("block_id").alias(name), F.col("ord").alias(f"{name}_ord"))
    placed = proposals.join(place("first"), ["document_id", "first"], "left").join(place("last"), ["document_id", "last"], "left").select("document_id", "proposal_id", F.col("first_ord").alias("low"), F.col("last_ord").alias("high"))
    missing = F.col("low").isNull() | F.col("high").isNull()
    sound = ~missing & (F.col("low") <= F.col("high"))
    faults = placed.where(~sound).select("document_id", "proposal_id", F.lit(None).cast("string").alias("block_id"), F.when(missing, "unknown block").otherwise("reversed").alias("problem"))
    # of what stands at one place proposals begin before blocks are seen
    events = placed.where(sound).select("document_id", "proposal_id", F.lit(None).cast("string").alias("block_id"), F.col("low").alias("ord"), "high", F.lit(0).alias("kind"))
    events = events.unionByName(blocks.where("is_critical").select("document_id", F.lit(None).cast(proposals.schema["proposal_id"].dataType).alias("proposal_id"), "block_id", "ord", F.lit(None).cast("int").alias("high"), F.lit(1).alias("kind")))
    before = F.max("high").over(W.partitionBy("document_id").orderBy("ord", "kind", "high", "proposal_id", "block_id").rowsBetween(W.unboundedPreceding, -1))
    seen = events.withColumn("reached", F.coalesce(before >= F.col("ord"), F.lit(False)))
    wrong = seen.where((F.col("kind") == 0) == F.col("reached"))
    return faults.unionByName(wrong.select("document_id", "proposal_id", "block_id", F.when(F.col("kind") == 0, "overlap").otherwise("not covered").alias("problem")))


def chosen_boundaries(rules: DataFrame, proposals: DataFrame, blocks: DataFrame, score: str = "0.985") -> DataFrame:
    """Candidates as split_questions gives them, with those of a document replaced by a model's proposals if none of these has a fault.

    The content is that of the source's blocks between the ends; a model gives ids alone. Proposals cover all critical blocks, so what the rules
    were unsure of (its split_score is below the accept line) is settled for the whole document or not at all.
    """
    body = blocks.where(~F.col("type").isin("header", "footer", "noise_candidate"))
    bad = interval_faults(proposals, body).select("document_id").distinct()
    sound = proposals.join(bad, "document_id", "left_anti")
    place = lambda name: body.select("document_id", F.col("block_id").alias(name), F.col("ord").alias(f"{name}_ord"))
    placed = sound.join(place("first"), ["document_id", "first"]).join(place("last"), ["document_id", "last"])
    body = body.withColumns({"number": question_number(F.col("resolved_label"), F.col("raw_text")), "part": F.lit(None).cast("struct<at: int, head: string>")})
    begins = body.join(placed.select("document_id", F.col("first_ord").alias("ord"), "last_ord"), ["document_id", "ord"], "left")
    along = W.partitionBy("document_id").orderBy("ord").rowsBetween(W.unboundedPreceding, 0)
    # each block between a proposal's ends; proposals do not overlap, so the last one begun is the block's own
    inside = begins.join(placed.select("document_id").distinct(), "document_id", "left_semi").withColumns({"end": F.last("last_ord", ignorenulls=True).over(along), "island": F.count("last_ord").over(along)}).where("ord <= end")
    found = _candidates(inside)
    made = found.withColumn("split_score", F.when(F.col("unresolved"), F.lit("0.90")).otherwise(F.lit(score)).cast(SCORE))
    kept = rules.join(placed.select("document_id").distinct(), "document_id", "left_anti")
    return kept.unionByName(made.select(*kept.columns))
