"""Registered queries: operators applied to whole tables, each with its SQL.

The tables are stand-ins for exam documents: a document's lines are blocks, labels are gate results, conversations
are questions and answers, events are calls and states.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable
from types import SimpleNamespace

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmill.functions.text import LANGUAGES, SPOKEN, asset_id, cache_key, grade_of, includes_picture, iso_language, language_signs, main_language, normalized_enum, slim_md5, static_info, with_default
from quillmill.operators import blocks, calibration, gates, graph, matching, providers, recognition, report, splitting, understanding, vectors
from quillmill.schemas import FINAL_FIELDS, IMAGE_CLASSES
from quillmill.sources import docx, files, runs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    files.ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _slim(x: str) -> str:
    return rf"md5(regexp_replace(regexp_replace(regexp_replace(nfc_normalize({x}), E'\r\n?', E'\n', 'g'), '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g'), '\n{{3,}}', E'\n\n', 'g'))"


@query(f"SELECT doc_id, {_slim('text')} AS slim_md5 FROM documents")
def slim_hash(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", slim_md5(F.col("text")).alias("slim_md5"))


@query("SELECT 'img_' || sha256(text)[1:16] AS asset_id, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1")
def content_dedup(spark, sf_dir):
    return read(spark, sf_dir, "documents").groupBy(asset_id(F.col("text")).alias("asset_id")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


def _outcomes(spark, sf_dir):
    joined = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    return gates.outcome(
        joined,
        [
            ("file", "DOCUMENT_PARSE_FAILED", F.col("text").isNull() | (F.col("text") == "")),
            ("recognition", "OCR_LOW_CONFIDENCE", F.coalesce(F.col("toxic"), F.lit(0)) == 1),
            ("split", "QUESTION_CONTENT_INCOMPLETE", F.col("n_chars") < 100),
            ("match", "ANSWER_NOT_FOUND", F.col("quality").isNull()),
            ("match", "ANSWER_MATCH_AMBIGUOUS", F.col("quality") == 0),
            ("contract", "LANGUAGE_UNRESOLVED", iso_language(F.col("lang")).isNull()),
        ],
    )


_LISTED = ", ".join(f"'{x}'" for x in LANGUAGES)
_OUTCOMES = f"""
    SELECT d.doc_id, d.lang, d.source, l.quality, CASE WHEN text IS NULL OR text = '' THEN 'file' WHEN toxic = 1 THEN 'recognition' WHEN n_chars < 100 THEN 'split'
        WHEN quality IS NULL OR quality = 0 THEN 'match' WHEN lang NOT IN ({_LISTED}) THEN 'contract' END AS stage,
      CASE WHEN text IS NULL OR text = '' THEN 'DOCUMENT_PARSE_FAILED' WHEN toxic = 1 THEN 'OCR_LOW_CONFIDENCE' WHEN n_chars < 100 THEN 'QUESTION_CONTENT_INCOMPLETE'
        WHEN quality IS NULL THEN 'ANSWER_NOT_FOUND' WHEN quality = 0 THEN 'ANSWER_MATCH_AMBIGUOUS' WHEN lang NOT IN ({_LISTED}) THEN 'LANGUAGE_UNRESOLVED' END AS reason_code
    FROM documents d LEFT JOIN labels l USING (doc_id)"""


@query(f"SELECT doc_id, stage, reason_code FROM ({_OUTCOMES})")
def first_failing_gate(spark, sf_dir):
    return _outcomes(spark, sf_dir).select("doc_id", "stage", "reason_code")


@query(f"SELECT lang, count(*) AS candidates, count(*) FILTER (reason_code IS NULL) AS accepted, count(*) FILTER (reason_code IS NOT NULL) AS rejected, round(avg((reason_code IS NULL)::int), 6) AS acceptance_rate FROM ({_OUTCOMES}) GROUP BY lang")
def acceptance_report(spark, sf_dir):
    return report.acceptance(_outcomes(spark, sf_dir), "lang")


@query(f"SELECT stage, reason_code, count(*) AS n FROM ({_OUTCOMES}) WHERE reason_code IS NOT NULL GROUP BY ALL")
def rejects_by_reason(spark, sf_dir):
    return report.rejects(_outcomes(spark, sf_dir))


@query(f"SELECT doc_id::varchar AS candidate_id, stage, reason_code, source AS source_file FROM ({_OUTCOMES}) WHERE reason_code IS NOT NULL")
def rejected_records(spark, sf_dir):
    out = gates.rejected(_outcomes(spark, sf_dir), F.col("doc_id"), F.array("source"))
    return out.select("candidate_id", "stage", "reason_code", F.get("source_files", 0).alias("source_file"))


@query("SELECT doc_id, (i - 1)::int AS ord, parts[i] AS raw_text FROM (SELECT doc_id, string_split(text, E'\\n') AS parts FROM documents), unnest(range(1, len(parts) + 1)) AS t(i)")
def block_explode(spark, sf_dir):
    return blocks.line_blocks(read(spark, sf_dir, "documents"), "doc_id", "text")


@query("SELECT doc_id, text FROM documents")
def blocks_rejoined(spark, sf_dir):
    parts = blocks.line_blocks(read(spark, sf_dir, "documents"), "doc_id", "text")
    return blocks.joined_in_order(parts, "doc_id", F.col("raw_text"))


def _states(spark, sf_dir):
    """Events as states of a run's items: users are runs, event types stages, values tell the state."""
    state = F.when(F.col("value") < 40, "RUNNING").when(F.col("value") < 60, "FAILED").otherwise("COMPLETED")
    return read(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), F.col("event_type").alias("stage"), (F.col("event_id") % 3).alias("item"), state.alias("state"), F.struct("ts", "event_id").alias("seq"))


_STATES = "SELECT user_id AS run_id, event_type AS stage, event_id % 3 AS item, CASE WHEN value < 40 THEN 'RUNNING' WHEN value < 60 THEN 'FAILED' ELSE 'COMPLETED' END AS state, ts, event_id FROM events"
_LATEST = f"SELECT * FROM ({_STATES}) QUALIFY row_number() OVER (PARTITION BY run_id, stage, item ORDER BY ts DESC, event_id DESC) = 1"


@query(f"SELECT run_id, stage, item, state, event_id FROM ({_LATEST})")
def latest_state(spark, sf_dir):
    return runs.latest(_states(spark, sf_dir)).select("run_id", "stage", "item", "state", F.col("seq.event_id").alias("event_id"))


@query(f"""WITH s(stage, n) AS (VALUES ('signup', 1), ('view', 2), ('click', 3), ('purchase', 4), ('error', 5)), r AS (SELECT DISTINCT run_id FROM ({_STATES})),
    done AS (SELECT run_id, stage FROM ({_LATEST}) GROUP BY ALL HAVING bool_and(state = 'COMPLETED'))
    SELECT run_id, (SELECT arg_min(stage, n) FROM s WHERE NOT EXISTS (FROM done d WHERE d.run_id = r.run_id AND d.stage = s.stage)) AS first_open FROM r""")
def first_incomplete(spark, sf_dir):
    return runs.first_incomplete(_states(spark, sf_dir), ("signup", "view", "click", "purchase", "error"))


@query(f"""SELECT run_id, event_id FROM (SELECT *, coalesce(lag(state) OVER (PARTITION BY run_id, stage, item ORDER BY ts, event_id), 'PENDING') AS before FROM ({_STATES}))
    WHERE before || '>' || state NOT IN ('PENDING>RUNNING', 'RUNNING>COMPLETED', 'RUNNING>FAILED', 'RUNNING>REJECTED', 'FAILED>RUNNING')""")
def illegal_moves(spark, sf_dir):
    return runs.illegal(_states(spark, sf_dir)).select("run_id", F.col("seq.event_id").alias("event_id"))


@query(f"SELECT item::bigint AS item FROM range(5) t(item) WHERE item NOT IN (SELECT item FROM ({_LATEST}) WHERE run_id = 1 AND stage = 'view' AND state = 'COMPLETED')")
def pending_items(spark, sf_dir):
    return runs.pending(spark.range(5).withColumnRenamed("id", "item"), _states(spark, sf_dir), "view", 1)


@query("""SELECT event_id, h.payload FROM events e LEFT JOIN (SELECT item_id, sha256(item_id || chr(0) || 'p' || chr(0) || 'm' || chr(0) || 'v1' || chr(0) || 'ocr') AS k, 'paid ' || item_id AS payload FROM benchmark WHERE item_id % 2 = 0) h
    ON h.k = sha256((event_id % 50) || chr(0) || 'p' || chr(0) || 'm' || chr(0) || 'v1' || chr(0) || 'ocr')""")
def cache_lookup(spark, sf_dir):
    of = lambda c: cache_key(c, *map(F.lit, ("p", "m", "v1", "ocr")))
    cache = read(spark, sf_dir, "benchmark").where("item_id % 2 = 0").select(of(F.col("item_id")).alias("cache_key"), F.concat(F.lit("paid "), "item_id").alias("payload"))
    hits, misses = runs.through_cache(read(spark, sf_dir, "events"), cache, of(F.col("event_id") % 50))
    return hits.select("event_id", "payload").unionByName(misses.select("event_id", F.lit(None).cast("string").alias("payload")))


@query("""SELECT conv_id, turn, text AS question, CASE WHEN next_role = 'assistant' THEN next_text END AS answer, CASE WHEN next_role = 'assistant' THEN NULL ELSE 'ANSWER_NOT_FOUND' END AS reason_code
    FROM (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user'""")
def question_answers(spark, sf_dir):
    w = W.partitionBy("conv_id").orderBy("turn")
    turns = read(spark, sf_dir, "conversations").withColumns({"next_role": F.lead("role").over(w), "next_text": F.lead("text").over(w)}).where("role = 'user'")
    answered = F.col("next_role").eqNullSafe("assistant")
    return turns.select("conv_id", "turn", F.col("text").alias("question"), F.when(answered, F.col("next_text")).alias("answer"), F.when(~answered, "ANSWER_NOT_FOUND").alias("reason_code"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_fields(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("""SELECT doc_id, CASE WHEN a IS NULL THEN 'ANSWER_NOT_FOUND' WHEN a < 0.995 OR a - b < 0.10 THEN 'ANSWER_MATCH_AMBIGUOUS' WHEN v IS NULL OR v < 0.995 OR verdict IS DISTINCT FROM 'PASS' THEN 'ANSWER_VERIFICATION_FAILED' ELSE 'PASS' END AS decision
    FROM (SELECT doc_id, CASE WHEN doc_id % 11 > 0 THEN (0.985 + (doc_id % 20) / 1000.0)::decimal(9,6) END AS a, coalesce(CASE WHEN doc_id % 3 > 0 THEN (0.88 + (doc_id % 17) / 1000.0)::decimal(9,6) END, 0) AS b,
    CASE WHEN doc_id % 5 > 0 THEN (0.99 + (doc_id % 9) / 1000.0)::decimal(9,6) END AS v, CASE doc_id % 7 WHEN 0 THEN 'FAIL' WHEN 1 THEN NULL ELSE 'PASS' END AS verdict FROM documents)""")
def abstention_cases(spark, sf_dir):
    k = F.col("doc_id")
    part = lambda base, n: F.lit(base).cast("decimal(9,6)") + (k % n).cast("decimal(9,6)") * F.lit("0.001").cast("decimal(9,6)")
    verdict = F.when(k % 7 == 0, "FAIL").when(k % 7 > 1, "PASS")
    return read(spark, sf_dir, "documents").select("doc_id", matching.abstention(F.when(k % 11 > 0, part("0.985", 20)), F.when(k % 3 > 0, part("0.88", 17)), F.when(k % 5 > 0, part("0.99", 9)), verdict).alias("decision"))


@query("""SELECT question, answer, top1, top2 FROM (SELECT q.conv_id || ':' || q.turn AS question, arg_max(a.turn, (s, -a.turn)) AS answer, max(s)::double AS top1, coalesce((list(s ORDER BY s DESC, a.turn))[2], 0)::double AS top2
    FROM (SELECT * FROM conversations WHERE role = 'user') q JOIN (SELECT * FROM conversations WHERE role = 'assistant') a ON q.conv_id = a.conv_id,
    LATERAL (SELECT (0.35 * (a.turn = q.turn + 1)::int + 0.10 * (a.turn > q.turn)::int + 0.10)::decimal(9,6) AS s) GROUP BY 1)""")
def best_answers(spark, sf_dir):
    # a score has three values by place, so the best two are among the next two answers and the first two: no pairs are made
    told = F.when(F.col("role") == "assistant", F.col("turn"))
    ahead = W.partitionBy("conv_id").orderBy("turn").rowsBetween(1, W.unboundedFollowing)
    turns = read(spark, sf_dir, "conversations").withColumn("one", F.first(told, ignorenulls=True).over(ahead))
    turns = turns.withColumn("two", F.first(F.when(told.isNotNull(), F.col("one")), ignorenulls=True).over(ahead))
    first = turns.where("role = 'assistant'").groupBy("conv_id").agg(F.min_by(F.struct("turn", "one"), "turn").alias("f"))
    near = turns.where("role = 'user'").join(first, "conv_id").select("conv_id", "turn", F.explode(F.array_distinct(F.array_compact(F.array("one", "two", "f.turn", "f.one")))).alias("answer"))
    score = matching.evidence_score({"number": (F.col("answer") == F.col("turn") + 1).cast("int"), "order": (F.col("answer") > F.col("turn")).cast("int"), "file": F.lit(1)})
    scored = near.select(F.concat_ws(":", "conv_id", "turn").alias("question"), "answer", score.alias("score"))
    return matching.top_two(scored, "question", "answer", "score").select("question", "answer", F.col("top1").cast("double").alias("top1"), F.col("top2").cast("double").alias("top2"))


def _sides(spark, sf_dir):
    """Questions and answers of a conversation; answers come in another order."""
    turns = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("cluster_id"), "turn", F.floor(F.col("turn") / 2).cast("int").alias("number"), F.concat_ws(":", "conv_id", "turn").alias("id"), "role", "text")
    return turns.where("role = 'user'").withColumn("ord", F.col("turn")), turns.where("role = 'assistant'").withColumn("ord", F.col("turn") * 5 % 8)


#: All rising sequences of a conversation's pairs; those match that every longest one has.
_ALIGNED = """
    t AS (SELECT conv_id::varchar AS c, turn, turn // 2 AS n, role, conv_id || ':' || turn AS id, text FROM conversations),
    tq AS (SELECT *, turn AS o FROM t WHERE role = 'user'), ta AS (SELECT *, turn * 5 % 8 AS o FROM t WHERE role = 'assistant'),
    oq AS (SELECT c, n, min(id) AS id, min(o) AS o FROM tq GROUP BY c, n HAVING count(*) = 1), oa AS (SELECT c, n, min(id) AS id, min(o) AS o FROM ta GROUP BY c, n HAVING count(*) = 1),
    pairs AS (SELECT oq.c, oq.id AS q, oa.id AS a, oq.o AS i, oa.o AS j FROM oq JOIN oa ON oq.c = oa.c AND oq.n = oa.n),
    chain AS (SELECT c, i, j, [q] AS ids FROM pairs UNION ALL SELECT p.c, p.i, p.j, list_append(ids, q) FROM chain x JOIN pairs p ON p.c = x.c AND p.i > x.i AND p.j > x.j),
    longest AS (SELECT c, ids, count(*) OVER (PARTITION BY c) AS n FROM chain QUALIFY len(ids) = max(len(ids)) OVER (PARTITION BY c)),
    matched AS (SELECT p.c, p.q, p.a FROM pairs p JOIN (SELECT c, unnest(ids) AS q, n FROM (SELECT c, ids, count(*) OVER (PARTITION BY c) AS n FROM longest)) s ON p.c = s.c AND p.q = s.q GROUP BY p.c, p.q, p.a HAVING count(*) = any_value(s.n))"""


@query(f"""WITH RECURSIVE {_ALIGNED}
    SELECT c AS cluster_id, 'match' AS op, q AS question_id, a AS answer_id FROM matched UNION ALL SELECT c, 'skip-question', id, NULL FROM tq WHERE id NOT IN (SELECT q FROM matched) UNION ALL SELECT c, 'skip-answer', NULL, id FROM ta WHERE id NOT IN (SELECT a FROM matched)""")
def sequence_alignment(spark, sf_dir):
    return matching.align(*_sides(spark, sf_dir))


#: All pairs of a conversation near each other or of one number, with their evidence.
_EVIDENCE = rf"""{_ALIGNED},
    qs AS (SELECT x.*, row_number() OVER w AS qp, count(*) OVER (PARTITION BY x.c) AS nq, m.a AS al, CASE turn % 3 WHEN 0 THEN 'choice' WHEN 1 THEN 'blank' ELSE 'open' END AS kind FROM tq x LEFT JOIN matched m ON m.q = x.id WINDOW w AS (PARTITION BY x.c ORDER BY x.o, x.id)),
    an AS (SELECT x.*, row_number() OVER (PARTITION BY c ORDER BY o, id) AS ap, count(*) OVER (PARTITION BY c) AS na, CASE turn % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'BA' WHEN 2 THEN '3' WHEN 3 THEN '(4' ELSE 'of 7' END AS answer FROM ta x),
    ql AS (SELECT z.*, an.ap AS spot FROM qs z LEFT JOIN an ON an.id = z.al),
    qb AS (SELECT *, last_value(spot IGNORE NULLS) OVER (PARTITION BY c ORDER BY qp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS low, first_value(spot IGNORE NULLS) OVER (PARTITION BY c ORDER BY qp ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS high,
        last_value(CASE WHEN spot IS NOT NULL THEN qp END IGNORE NULLS) OVER (PARTITION BY c ORDER BY qp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lq FROM ql),
    p AS (SELECT qb.*, an.id AS a, an.n AS m, an.turn AS aturn, an.ap, an.na, an.answer, regexp_matches(an.answer, '^[A-H]+$') AS letters, CASE qb.kind WHEN 'choice' THEN 'x A. 1 B. 2' WHEN 'blank' THEN '____' ELSE 'part of 7' END AS stem
        FROM qb JOIN an ON an.c = qb.c AND (an.n = qb.n OR abs(an.ap - qp) <= 2 OR abs(an.ap - coalesce(low + qp - lq, qp)) <= 2)),
    evidence AS (SELECT c AS cluster_id, id AS q, a, qp, ap, turn % 4 = 1 AND aturn % 4 = 2 AS conflict, (n = m)::int AS number, coalesce((al = a)::int, 0) AS "sequence", (aturn % 3 > 0)::int AS file, ((kind = 'choice') = letters)::int AS type, (na <= nq)::int AS counts,
      CASE WHEN letters THEN (answer = 'A')::int ELSE (answer <> '(4')::int END AS format, (coalesce(low < ap, true) AND coalesce(ap < high, true) AND (low IS NOT NULL OR high IS NOT NULL OR (nq = 1 AND na = 1)))::int AS "order",
      CASE kind WHEN 'choice' THEN letters::int WHEN 'blank' THEN 1 ELSE (answer = 'of 7')::int END AS semantic, (turn % 4 <> 1 AND aturn % 4 < 2)::int AS title FROM p)"""


def _told_sides(spark, sf_dir):
    """Both sides with what signals reads. An answer's file is another one for every third turn; its fields agree, differ or say nothing."""
    q, a = _sides(spark, sf_dir)
    turn = F.col("turn")
    kind = F.when(turn % 3 == 0, "选择题").when(turn % 3 == 1, "填空题").otherwise("未知")
    stem = F.when(turn % 3 == 0, "x A. 1 B. 2").when(turn % 3 == 1, "____").otherwise("part of 7")
    answer = F.coalesce(*[F.when(turn % 5 == i, v) for i, v in enumerate(("A", "BA", "3", "(4"))], F.lit("of 7"))
    absent = F.lit(None).cast("string")
    q = q.select("*", F.lit("Q").alias("document"), F.lit("exam").alias("file"), F.array(F.when(turn % 4 != 1, "数学"), F.when(turn % 4 == 1, "2024")).alias("fields"), kind.alias("kind"), stem.alias("stem"))
    a = a.select("*", F.lit("A").alias("document"), F.when(turn % 3 > 0, "exam").otherwise("other").alias("file"), F.when(turn % 4 < 2, F.array(F.lit("数学"), absent)).when(turn % 4 == 2, F.array(absent, F.lit("2023"))).otherwise(F.array(absent, absent)).alias("fields"), answer.alias("answer"))
    return q, a


@query(f"""WITH RECURSIVE {_EVIDENCE} SELECT * EXCLUDE (qp, ap) FROM evidence""")
def match_evidence(spark, sf_dir):
    """All signals."""
    return matching.signals(*_told_sides(spark, sf_dir)).drop("qp", "ap")


@query(f"""WITH RECURSIVE {_EVIDENCE},
    gains AS (SELECT cluster_id AS c, q, a, qp, ap, 350000 * number + 100000 * file + 100000 * type + 50000 * counts + 50000 * format + 50000 * semantic + 50000 * title AS gain FROM evidence WHERE NOT conflict),
    walk AS (SELECT c, qp, ap, gain + 200000 AS total, [q] AS qs, [a] AS answers FROM gains WHERE gain > 0
        UNION ALL SELECT g.c, g.qp, g.ap, total + gain + 200000, list_append(qs, q), list_append(answers, a) FROM walk w JOIN gains g ON g.c = w.c AND g.qp > w.qp AND g.ap > w.ap WHERE gain > 0),
    best AS (SELECT c, qs, answers, count(*) OVER (PARTITION BY c) AS n FROM (SELECT * FROM walk QUALIFY total = max(total) OVER (PARTITION BY c)))
    SELECT c AS cluster_id, q, a AS aligned FROM (SELECT c, n, unnest(qs) AS q, unnest(answers) AS a FROM best) GROUP BY c, q, a HAVING count(*) = any_value(n)""")
def weighted_alignment(spark, sf_dir):
    """The pairs that every best alignment has, by evidence and gaps; blocks of two questions, so that most conversations are several."""
    return matching.weighed(*_told_sides(spark, sf_dir), block=2)


def _lines(spark, sf_dir):
    """Turns as blocks: a user's turn begins a question or answer with its number, others go on with it."""
    turn = F.col("turn")
    said = F.when(turn % 3 == 0, "A. x B. y").when(turn % 3 == 1, "____").otherwise("tell")
    text = F.when(F.col("role") == "user", F.concat((F.floor(turn / 2) + 1).cast("string"), F.lit(". "), said)).when(F.col("role") == "assistant", F.concat(F.lit("goes on "), turn)).otherwise("head")
    kind = F.when(F.col("role") == "system", "header").otherwise("paragraph")
    return read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("document_id"), F.concat_ws(":", "conv_id", "turn").alias("block_id"), turn.cast("int").alias("ord"), kind.alias("type"), text.alias("raw_text"), F.lit(None).cast("string").alias("resolved_label"))


_ISLANDS = """SELECT *, sum((role = 'user')::int) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)::bigint AS island FROM conversations WHERE role <> 'system'"""


@query(f"""SELECT conv_id || '_q' || lpad(island::varchar, 4, '0') AS question_candidate_id, count(*) AS blocks, (min(turn) // 2 + 1)::varchar AS question_number, CASE min(turn) % 3 WHEN 0 THEN '选择题' WHEN 1 THEN '填空题' ELSE '未知' END AS question_type_candidate,
    CASE WHEN min(turn) // 2 + 1 = island THEN 0.99 ELSE 0.95 END::double AS split_score FROM ({_ISLANDS}) WHERE island > 0 GROUP BY conv_id, island""")
def question_splitting(spark, sf_dir):
    found = splitting.split_questions(_lines(spark, sf_dir))
    return found.select("question_candidate_id", F.size("content_blocks").cast("long").alias("blocks"), "question_number", "question_type_candidate", F.col("split_score").cast("double").alias("split_score"))


@query(f"""SELECT min(conv_id || ':' || turn) || '_a0' AS answer_candidate_id, (min(turn) // 2 + 1)::varchar AS question_number, CASE min(turn) % 3 WHEN 0 THEN 'A. x B. y' WHEN 1 THEN '____' ELSE 'tell' END || coalesce(string_agg(CASE WHEN role = 'assistant' THEN chr(10) || 'goes on ' || turn END, '' ORDER BY turn), '') AS answer,
    '略' AS analysis, string_agg(conv_id || ':' || turn, ',' ORDER BY turn) AS source_blocks FROM ({_ISLANDS}) WHERE island > 0 GROUP BY conv_id, island""")
def answer_extraction(spark, sf_dir):
    found = splitting.extract_answers(_lines(spark, sf_dir))
    return found.select("answer_candidate_id", "question_number", "answer", "analysis", F.array_join("source_blocks", ",").alias("source_blocks"))


@query(f"""SELECT min(conv_id || ':' || turn) || '_a0' AS answer_candidate_id FROM ({_ISLANDS}) WHERE island > 0 GROUP BY conv_id, island HAVING count(*) FILTER (turn % 4 = 3) > 0 OR min(turn) % 3 = 1 AND count(*) = 1""")
def unsupported_answers(spark, sf_dir):
    """Answers whose blocks are not all there, or do not hold them: one block in four is gone, a blank alone is made up."""
    parts = _lines(spark, sf_dir)
    found = splitting.extract_answers(parts)
    told = found.withColumn("answer", F.when(F.col("answer") == "____", "made up").otherwise(F.col("answer")))
    return splitting.unsupported(told, parts.where("ord % 4 <> 3")).select("answer_candidate_id")


@query("""SELECT conv_id::varchar AS document_id, count(*) = max(turn) + 1 AS stable, bool_and(turn % 3 > 0 OR turn < 6) AS images_there FROM conversations WHERE NOT (conv_id % 3 = 0 AND turn = 1) GROUP BY conv_id""")
def block_integrity(spark, sf_dir):
    parts = read(spark, sf_dir, "conversations").where("NOT (conv_id % 3 = 0 AND turn = 1)").select(F.col("conv_id").cast("string").alias("document_id"), F.col("turn").alias("ord"), F.when(F.col("turn") % 3 == 0, "image").otherwise("paragraph").alias("type"), F.when(F.col("turn") % 3 == 0, F.col("turn")).alias("asset_id"))
    return gates.block_gate(parts, spark.range(6).withColumnRenamed("id", "asset_id"))


@query(f"""WITH o AS (SELECT conv_id, island, conv_id || ':' || turn AS b, turn FROM ({_ISLANDS}) WHERE island > 0), owned AS (SELECT b FROM o UNION ALL SELECT b FROM o WHERE turn % 5 = 4)
    SELECT b AS block_id, 'owned twice' AS problem FROM owned GROUP BY b HAVING count(*) > 1 UNION ALL SELECT conv_id || ':' || turn, 'not owned' FROM conversations WHERE turn % 2 = 0 AND conv_id || ':' || turn NOT IN (SELECT b FROM owned)""")
def block_ownership(spark, sf_dir):
    parts = _lines(spark, sf_dir).withColumn("is_critical", F.col("ord") % 2 == 0)
    found = splitting.split_questions(parts)
    extra = found.select(F.filter("content_blocks", lambda b: F.substring_index(b, ":", -1).cast("int") % 5 == 4).alias("content_blocks"))
    return gates.ownership_gate(found.select("content_blocks").unionByName(extra), parts)


@query("""SELECT conv_id::varchar AS document_id, turn, CASE WHEN noisy AND (role = 'system' OR n >= 3) THEN 'noise_candidate' WHEN role = 'system' THEN 'header' ELSE 'paragraph' END AS type FROM
    (SELECT *, role <> 'user' AS noisy, count(*) OVER (PARTITION BY conv_id, CASE role WHEN 'user' THEN 'words' WHEN 'assistant' THEN 'p1' ELSE 'url' END) AS n FROM conversations)""")
def noise_lines(spark, sf_dir):
    line = F.when(F.col("role") == "user", "words").when(F.col("role") == "assistant", "Page 1 of 9").otherwise("www.example.org")
    parts = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("document_id"), "turn", line.alias("normalized_text"), F.when(F.col("role") == "system", "header").otherwise("paragraph").alias("type"))
    return blocks.noise_candidates(parts).select("document_id", "turn", "type")


@query("""SELECT k AS block_id, CASE WHEN contents > 1 THEN 'reject' WHEN s IS NULL OR s < 0.90 THEN 'reject' WHEN s >= 0.98 THEN 'accept' WHEN n > 1 THEN 'reject' ELSE 'fallback' END AS action FROM
    (SELECT event_id % 700 AS k, max(s) AS s, count(*) AS n, count(DISTINCT CASE WHEN s >= 0.95 THEN event_type END) AS contents FROM (SELECT *, CASE WHEN event_type <> 'error' THEN least(1, (0.5 * (0.8 + (event_id % 23) / 100.0)::decimal(9,6) + 0.5)::decimal(9,6)) END AS s FROM events) GROUP BY 1)""")
def recognition_conflicts(spark, sf_dir):
    """Several results a block: calibrated, with an unknown model's not trusted; two sure ones that differ are a conflict."""
    k = F.col("event_id")
    raw = F.lit("0.8").cast("decimal(9,6)") + (k % 23).cast("decimal(9,6)") / F.lit(100).cast("decimal(9,6)")
    told = read(spark, sf_dir, "events").select((k % 700).alias("block_id"), F.col("event_type").alias("content"), F.lit("p").alias("provider"), F.when(F.col("event_type") == "error", "unknown").otherwise("m").alias("model"), F.lit("ocr").alias("task"), F.lit(True).alias("is_critical"), raw.cast("decimal(9,6)").alias("raw_score"))
    scale = spark.createDataFrame([("p", "m", "ocr")], "provider string, model string, task string").withColumns({"slope": F.lit("0.5").cast("decimal(9,6)"), "shift": F.lit("0.5").cast("decimal(9,6)")})
    return recognition.settled(recognition.calibrated(told, scale)).select("block_id", "action")


@query("""SELECT doc_id, CASE doc_id % 12 WHEN 0 THEN 'text_ocr' WHEN 1 THEN 'formula' WHEN 2 THEN 'table' WHEN 3 THEN 'vision_llm' WHEN 9 THEN 'multimodal' WHEN 10 THEN 'multimodal' WHEN 11 THEN 'multimodal' ELSE 'keep_vision' END AS service FROM documents""")
def image_routes(spark, sf_dir):
    names = F.array(*map(F.lit, IMAGE_CLASSES))
    return read(spark, sf_dir, "documents").select("doc_id", recognition.route(F.get(names, (F.col("doc_id") % 12).cast("int"))).alias("service"))


@query("""SELECT doc_id, CASE WHEN n_chars % 3 = 0 AND doc_id % 4 < 3 AND doc_id % 5 > 0 THEN 'QUESTION' WHEN n_chars % 3 = 0 THEN 'UNKNOWN' ELSE 'ANSWER' END AS document_class FROM documents""")
def fused_classes(spark, sf_dir):
    """A model's class counts where the rules tell none, it is a listed one, and what it cites is there in order."""
    k = F.col("doc_id")
    rule = F.when(F.col("n_chars") % 3 == 0, "UNKNOWN").otherwise("ANSWER")
    model = F.when(k % 4 < 3, "QUESTION").otherwise("ESSAY")
    cited = F.when(k % 5 > 0, F.array(F.lit("b1"), F.lit("b3"))).otherwise(F.array(F.lit("b3"), F.lit("b1")))
    return read(spark, sf_dir, "documents").select("doc_id", understanding.fused_class(rule, model, cited, F.array(*map(F.lit, ("b1", "b2", "b3")))).alias("document_class"))


@query("SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id)")
def unowned(spark, sf_dir):
    return blocks.dangling(read(spark, sf_dir, "documents").select("doc_id"), read(spark, sf_dir, "labels"), "doc_id")


@query("""SELECT DISTINCT doc_id FROM (SELECT doc_id, unnest(string_split(text, E'\\n')) AS line FROM documents) WHERE line IN (SELECT unnest(string_split(text, E'\\n')) FROM benchmark) AND length(line) >= 20""")
def shared_blocks(spark, sf_dir):
    mine = blocks.line_blocks(read(spark, sf_dir, "documents"), "doc_id", "text").where("char_length(raw_text) >= 20")
    theirs = blocks.line_blocks(read(spark, sf_dir, "benchmark"), "item_id", "text").select("raw_text")
    return mine.join(theirs, "raw_text", "left_semi").select("doc_id").distinct()


@query("SELECT o_custkey, o_orderkey, expected FROM (SELECT o_custkey, o_orderkey, (lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) + 1)::bigint AS expected FROM orders) WHERE o_orderkey <> expected")
def numbering_gaps(spark, sf_dir):
    return blocks.gaps(read(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", "o_orderkey").select("o_custkey", "o_orderkey", "expected")


@query("""SELECT user_id, island, count(*) AS n, min(event_id) AS first_event FROM (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::bigint AS island FROM
    (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS s FROM events)) GROUP BY ALL""")
def event_islands(spark, sf_dir):
    before = F.lag("ts").over(W.partitionBy("user_id").orderBy("ts", "event_id"))
    marked = read(spark, sf_dir, "events").withColumn("starts", ~F.coalesce(F.col("ts") - before <= F.expr("INTERVAL 6 HOURS"), F.lit(False)))
    return blocks.islands(marked, "user_id", ["ts", "event_id"], F.col("starts")).groupBy("user_id", "island").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


@query("""SELECT c_custkey::varchar AS document_id, 'course' AS field, coalesce(min(o_orderpriority) FILTER (o_orderstatus = 'F'), min(o_orderpriority), c_mktsegment) AS value,
    CASE WHEN count(*) FILTER (o_orderstatus = 'F') > 0 THEN 'document' WHEN count(o_orderkey) > 0 THEN 'file_name' ELSE 'cluster' END AS source FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_mktsegment""")
def source_priority(spark, sf_dir):
    value = lambda key, text, source: [F.col(key).cast("string").alias("document_id"), F.lit("course").alias("field"), F.col(text).alias("value"), source.alias("source"), F.lit("0.9").cast("decimal(9,6)").alias("score")]
    told = read(spark, sf_dir, "orders").select(*value("o_custkey", "o_orderpriority", F.when(F.col("o_orderstatus") == "F", "document").otherwise("file_name")))
    lent = read(spark, sf_dir, "customer").select(*value("c_custkey", "c_mktsegment", F.lit("cluster")))
    return understanding.prioritised(told.unionByName(lent), "document_id").select("document_id", "field", "value", "source")


@query(f"""SELECT count(*) FILTER (a) AS accepted, count(*) FILTER (g) AS gold, count(*) FILTER (a AND g AND got = want) AS correct, count(*) FILTER (a AND g AND got <> want) AS wrong_answers,
    round(count(*) FILTER (a AND g AND got = want) / nullif(count(*) FILTER (a), 0), 6) AS precision, round(count(*) FILTER (a AND g AND got = want) / nullif(count(*) FILTER (g), 0), 6) AS recall
    FROM (SELECT coalesce(x.a, false) AS a, coalesce(y.g, false) AS g, got, want FROM (SELECT doc_id, lang AS got, true AS a FROM ({_OUTCOMES}) WHERE reason_code IS NULL) x FULL JOIN
    (SELECT doc_id, lang AS want, true AS g FROM documents JOIN labels USING (doc_id) WHERE quality = 1) y USING (doc_id))""")
def gold_metrics(spark, sf_dir):
    actual = gates.accepted(_outcomes(spark, sf_dir)).select("doc_id", F.col("lang").alias("answer"))
    gold = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels").where("quality = 1"), "doc_id").select("doc_id", F.col("lang").alias("answer"))
    return report.gold_metrics(actual, gold, "doc_id")


@query("SELECT event_type AS service, count(*) AS calls, count(*) FILTER (value < 10) AS errors, round(avg((event_id % 4 = 0)::int), 6) AS hit_rate, round(sum(value::decimal(18,6)), 3)::double AS total, round(avg(value), 4) AS mean FROM events GROUP BY 1")
def call_ledger(spark, sf_dir):
    events = read(spark, sf_dir, "events").withColumnRenamed("event_type", "service")
    out = report.calls(events, "service", F.col("value").cast("decimal(18,6)"), F.col("value") < 10, F.col("event_id") % 4 == 0)
    return out.withColumns({"total": F.col("total").cast("double"), "mean": F.col("mean").cast("double")})


@query("SELECT doc_id, CASE WHEN s < 0.90 THEN 'reject' WHEN s >= (CASE WHEN lang = 'en' THEN 0.98 ELSE 0.95 END) THEN 'accept' ELSE 'fallback' END AS action FROM (SELECT doc_id, lang, (0.85 + (doc_id % 16) / 100.0)::decimal(9,6) AS s FROM documents)")
def accept_ladder(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    score = F.lit("0.85").cast("decimal(9,6)") + (F.col("doc_id") % 16).cast("decimal(9,6)") / F.lit(100).cast("decimal(9,6)")
    return docs.select("doc_id", recognition.ladder(score, F.col("lang") == "en").alias("action"))


@query("""SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, len(regexp_extract_all(html, '<nav>|<footer>'))::int AS metadata_blocks, (html LIKE '%<img src="image/%')::int AS is_pic_included FROM pages""")
def page_metadata(spark, sf_dir):
    pages = read(spark, sf_dir, "pages")
    return pages.select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.regexp_count("html", F.lit("<nav>|<footer>")).alias("metadata_blocks"), includes_picture(F.col("html")).alias("is_pic_included"))


@query(f"SELECT o.doc_id, o.lang, o.source, b.blocks, o.reason_code FROM ({_OUTCOMES}) o JOIN (SELECT doc_id, len(string_split(text, E'\\n')) AS blocks FROM documents) b USING (doc_id)")
def lineage(spark, sf_dir):
    parts = blocks.line_blocks(read(spark, sf_dir, "documents"), "doc_id", "text").groupBy("doc_id").agg(F.count("*").alias("blocks"))
    return _outcomes(spark, sf_dir).join(parts, "doc_id").select("doc_id", "lang", "source", "blocks", "reason_code")


@query(f"SELECT doc_id, {_slim('text')} AS md5, source AS file, 'v1' AS version FROM documents")
def static_information(spark, sf_dir):
    info = static_info(F.col("text"), source_files=F.array("source"))
    field = lambda p: F.get_json_object("info", p)
    return read(spark, sf_dir, "documents").select("doc_id", info.alias("info")).select("doc_id", field("$.slim_question_md5").alias("md5"), field("$.source_files[0]").alias("file"), field("$.slim_md5_version").alias("version"))


@query("""SELECT p_partkey, CASE v WHEN '初一' THEN '初中一年级' WHEN '高二' THEN '高中二年级' ELSE coalesce(v, '未知') END AS level, CASE WHEN v = '初一' THEN '初中' WHEN v = '高二' THEN '高中' ELSE '未知' END AS grade
    FROM (SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN '初一' WHEN 1 THEN '高二' END AS v FROM part)""")
def enum_normalization(spark, sf_dir):
    value = F.when(F.col("p_size") % 3 == 0, "初一").when(F.col("p_size") % 3 == 1, " 高二")
    level = with_default(normalized_enum(value, "text_grade_level"), "text_grade_level")
    return read(spark, sf_dir, "part").select("p_partkey", level.alias("level")).select("p_partkey", "level", grade_of(F.col("level")).alias("grade"))


@query("""SELECT conv_id::varchar AS document_id, asks AS n_questions, tells AS n_answers, CASE WHEN asks > 0 AND tells > 0 THEN 'MIXED' WHEN tells > 0 THEN 'ANSWER' WHEN asks > 0 THEN 'QUESTION' ELSE 'UNKNOWN' END AS document_class
    FROM (SELECT conv_id, count(*) FILTER (role = 'user') AS asks, count(*) FILTER (role = 'assistant') AS tells FROM conversations GROUP BY conv_id)""")
def document_classes(spark, sf_dir):
    line = F.when(F.col("role") == "user", F.concat("turn", F.lit(". question"))).when(F.col("role") == "assistant", F.concat(F.lit("【答案】"), "text"))
    parts = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("document_id"), F.col("turn").alias("ord"), F.lit("paragraph").alias("type"), line.alias("raw_text"), F.lit(None).cast("string").alias("resolved_label"))
    return understanding.classify(understanding.features(parts)).select("document_id", "n_questions", "n_answers", "document_class")


@query("""SELECT o_orderkey::varchar AS document_id, CASE WHEN o_orderstatus = 'F' THEN '数学' ELSE '物理' END AS course, CASE WHEN o_orderkey % 3 = 0 THEN '高中二年级' ELSE '初中一年级' END AS level,
    year(o_orderdate)::varchar AS year, CASE WHEN o_orderkey % 2 = 0 THEN '北京' END AS city, CASE WHEN o_orderkey % 5 = 0 THEN '高考' END AS exam FROM orders""")
def file_metadata(spark, sf_dir):
    k = F.col("o_orderkey")
    name = F.concat(F.year("o_orderdate").cast("string"), F.lit("年"), F.when(k % 2 == 0, "北京市").otherwise(""), F.when(k % 3 == 0, "高二").otherwise("初一"), F.when(k % 5 == 0, "高考").otherwise(""), F.when(F.col("o_orderstatus") == "F", "数学").otherwise("物理"), F.lit("试卷.docx"))
    names = read(spark, sf_dir, "orders").select(k.cast("string").alias("document_id"), name.alias("source_file"))
    nothing = spark.createDataFrame([], "document_id string, ord int, type string, raw_text string")
    return understanding.wide(understanding.prioritised(understanding.metadata_values(names, nothing), "document_id"), "document_id")


#: Documents of one name part by year; then of several with questions or answers those two stay whose numbers are alike and nobody else's.
@query("""WITH d AS (SELECT p_partkey::varchar AS d, concat_ws('x', p_brand, p_type, p_size // 8) AS name, p_partkey % 2 = 0 AS asks, CASE WHEN p_partkey % 7 > 0 THEN p_size % 2 END AS year, p_partkey % 3 AS numbers FROM part),
    y AS (SELECT *, min(year) OVER w <> max(year) OVER w AS differ FROM d WINDOW w AS (PARTITION BY name)),
    l AS (SELECT *, CASE WHEN differ AND year IS NULL THEN d WHEN differ THEN name || year ELSE name END AS part FROM y),
    r AS (SELECT *, count(*) FILTER (asks) OVER w > 1 OR count(*) FILTER (NOT asks) OVER w > 1 AS crowded, count(*) FILTER (asks) OVER s = 1 AND count(*) FILTER (NOT asks) OVER s = 1 AS couple FROM l WINDOW w AS (PARTITION BY part), s AS (PARTITION BY part, numbers)),
    h AS (SELECT *, CASE WHEN NOT crowded THEN part WHEN couple THEN part || ':' || numbers ELSE d END AS home FROM r),
    t AS (SELECT *, NOT asks AND count(*) OVER w > 1 AND min(CASE WHEN asks THEN numbers END) OVER w < numbers AS lost FROM h WINDOW w AS (PARTITION BY home))
    SELECT d AS document_id, 'exam_' || min(d) OVER (PARTITION BY CASE WHEN lost THEN 'lost' || d ELSE home END) AS cluster_id FROM t""")
def exam_clusters(spark, sf_dir):
    """Parts as documents: a question or answer document each, some without a year. The numbers of one are 1, 1 to 3 or 1 to 9."""
    even, k = F.col("p_partkey") % 2 == 0, F.col("p_partkey")
    name = F.concat(F.col("p_brand"), F.lit("x"), F.col("p_type"), F.lit("x"), F.floor(F.col("p_size") / 8).cast("string"), F.when(even, "试卷").otherwise("答案"), F.lit(".docx"))
    absent, none = F.lit(None).cast("string"), F.array().cast("array<string>")
    numbers = F.transform(F.sequence(F.lit(1), F.element_at(F.array(F.lit(1), F.lit(3), F.lit(9)), (k % 3 + 1).cast("int"))), lambda n: n.cast("string"))
    rows = read(spark, sf_dir, "part").select(k.cast("string").alias("document_id"), name.alias("source_file"), absent.alias("title"), F.when(even, "QUESTION").otherwise("ANSWER").alias("document_class"), F.when(even, numbers).otherwise(none).alias("question_numbers"), F.when(even, none).otherwise(numbers).alias("answer_numbers"), F.when(k % 7 > 0, (F.col("p_size") % 2).cast("string")).alias("year"))
    return understanding.clusters(rows.withColumns({f: absent for f in understanding.FIELDS if f != "year"}))


@query("SELECT item_id, text AS content, 'accept' AS action FROM benchmark")
def recognised_items(spark, sf_dir):
    """What the ledger of calls has is not asked again: each item's recognised text comes from its row there, calibrated and settled."""
    items = read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("block_id"), F.lit("text_ocr").alias("task"), F.lit(True).alias("is_critical"), F.encode("text", "UTF-8").alias("content"))
    service = SimpleNamespace(name="reader", model="1")
    key = cache_key(F.sha2("content", 256), F.lit(service.name), F.lit(service.model), F.lit("v1"), F.col("task"))
    absent = {c: F.lit(None).cast(t) for c, t in (("latency", "double"), ("tokens", "long"), ("cost", "double"), ("error", "string"))}
    ledger = items.select(key.alias("cache_key"), F.lit("reader").alias("provider"), F.lit("1").alias("model"), F.lit("r").alias("request_id"), F.lit("v1").alias("prompt_version"), "task", F.lit("0.9").cast("decimal(9,6)").alias("raw_score"), F.decode("content", "UTF-8").alias("content"), *[v.alias(k) for k, v in absent.items()])
    told = spark.createDataFrame([("reader", "1", "text_ocr", "0.5", True), ("reader", "1", "text_ocr", "0.5", False), ("reader", "1", "text_ocr", "0.8", True)], "provider string, model string, task string, raw_score string, correct boolean")
    settled, _ = providers.recognised(items, service, None, calibration.fit(told, "v1"), ledger, 8)
    return settled.select(F.col("block_id").alias("item_id"), "content", "action")


@query("""WITH e AS (SELECT event_type AS provider, event_id * 37 % 1000 AS k, (event_id * 37 % 1000) / 1000 AS score, event_id * 7919 % 1000 < event_id * 37 % 1000 AS correct FROM events WHERE value >= 1),
    b AS (SELECT provider, k * 50 // 1000 AS bin, avg(score) AS place, count(*) AS n, count(*) FILTER (correct) AS r FROM e GROUP BY ALL),
    s AS (SELECT *, row_number() OVER w AS i, sum(n) OVER w AS sn, sum(r) OVER w AS sr FROM b WINDOW w AS (PARTITION BY provider ORDER BY bin)),
    spans AS (SELECT x.provider, x.i AS j, y.i AS k, (y.sr - x.sr + x.r)::double / (y.sn - x.sn + x.n) AS share FROM s x JOIN s y ON x.provider = y.provider AND x.i <= y.i),
    low AS (SELECT s.provider, s.i, j, min(share) AS least FROM s JOIN spans p ON s.provider = p.provider AND j <= s.i AND k >= s.i GROUP BY ALL),
    fit AS (SELECT provider, i, max(least) AS value FROM low GROUP BY ALL)
    SELECT provider, round(round(sum(place * n) / sum(n), 6), 4) AS "at", round(round(any_value(value), 6)::double, 6) AS value FROM s JOIN fit USING (provider, i) GROUP BY provider, round(value, 12)""")
def calibration_knots(spark, sf_dir):
    """The isotonic fit of each provider's scores; the SQL takes the greatest of the least shares of all spans of bins."""
    k = F.col("event_id")
    told = read(spark, sf_dir, "events").where("value >= 1").select(F.col("event_type").alias("provider"), F.lit("m").alias("model"), F.lit("t").alias("task"), ((k * 37 % 1000) / 1000).cast("decimal(9,6)").alias("raw_score"), (k * 7919 % 1000 < k * 37 % 1000).alias("correct"))
    each = calibration.fit(told, "v1", 50).select("provider", F.explode("knots").alias("k"))
    return each.select("provider", F.round(F.col("k.at").cast("double"), 4).alias("at"), F.col("k.value").cast("double").alias("value"))


@query("""WITH b AS (SELECT conv_id, turn, conv_id || ':' || turn AS id, turn % 2 = 0 AS critical FROM conversations),
    p AS (SELECT conv_id, turn, conv_id || '/' || turn AS p, turn AS lo, CASE WHEN turn % 5 = 4 THEN turn - 1 ELSE turn + (conv_id + turn) % 3 END AS hi FROM b WHERE turn % 2 = 0 AND (conv_id + turn) % 7 > 0),
    k AS (SELECT p.*, EXISTS (SELECT 1 FROM b WHERE b.conv_id = p.conv_id AND b.turn = hi) AS known FROM p),
    s AS (SELECT * FROM k WHERE known AND hi >= lo)
    SELECT conv_id::varchar AS document_id, p AS proposal_id, NULL::varchar AS block_id, CASE WHEN known THEN 'reversed' ELSE 'unknown block' END AS problem FROM k WHERE NOT known OR hi < lo
    UNION ALL SELECT x.conv_id::varchar, x.p, NULL, 'overlap' FROM s x WHERE EXISTS (SELECT 1 FROM s y WHERE y.conv_id = x.conv_id AND y.lo < x.lo AND y.hi >= x.lo)
    UNION ALL SELECT conv_id::varchar, NULL, id, 'not covered' FROM b WHERE critical AND NOT EXISTS (SELECT 1 FROM s WHERE s.conv_id = b.conv_id AND s.lo <= b.turn AND b.turn <= s.hi)""")
def boundary_faults(spark, sf_dir):
    """Turns as blocks and proposed questions of one to three turns; some end before they begin or at no block, some overlap."""
    turn, conv = F.col("turn"), F.col("conv_id")
    parts = read(spark, sf_dir, "conversations").select(conv.cast("string").alias("document_id"), F.concat_ws(":", "conv_id", "turn").alias("block_id"), turn.cast("int").alias("ord"), (turn % 2 == 0).alias("is_critical"))
    last = F.when(turn % 5 == 4, turn - 1).otherwise(turn + (conv + turn) % 3)
    told = read(spark, sf_dir, "conversations").where((turn % 2 == 0) & ((conv + turn) % 7 > 0)).select(conv.cast("string").alias("document_id"), F.concat_ws("/", "conv_id", "turn").alias("proposal_id"), F.concat_ws(":", "conv_id", "turn").alias("first"), F.concat_ws(":", "conv_id", last).alias("last"))
    return splitting.interval_faults(told, parts)


@query("""WITH d AS (SELECT p_partkey AS k, p_size AS n FROM part), c AS (SELECT k, n, unnest(range(1, 13)) AS i FROM d)
    SELECT k::varchar AS document_id, i AS place, i::varchar AS question_number, substr('ABCD', 1 + (n + i) % 4, 1) AS answer FROM c
    UNION ALL SELECT k, 13, '13', 'the height is' || chr(10) || n || '.5 m' || CASE WHEN n % 2 = 0 THEN chr(10) || '7. of a list' ELSE '' END FROM d
    UNION ALL SELECT k, 14, '14', '3.14' FROM d UNION ALL SELECT k, 15, '1', '2024.5' FROM d""")
def answer_lines(spark, sf_dir):
    """Twelve answers in one block, a decimal at the beginning of a line, a number that goes back, and a part that counts anew."""
    n = F.col("p_size")
    listed = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(12)), lambda i: F.concat(i.cast("string"), F.lit(". "), F.substring(F.lit("ABCD"), (1 + (n + i) % 4).cast("int"), F.lit(1)))), " ")
    lines = [F.lit("参考答案"), listed, F.concat(F.lit("13. the height is\n"), n.cast("string"), F.lit(".5 m"), F.when(n % 2 == 0, "\n7. of a list").otherwise("")), F.lit("14. 3.14"), F.lit("二、填空题"), F.lit("1. 2024.5")]
    parts = read(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("document_id"), F.posexplode(F.array(*lines)).alias("ord", "raw_text"))
    parts = parts.select("document_id", F.concat_ws("_", "document_id", "ord").alias("block_id"), "ord", F.lit("paragraph").alias("type"), "raw_text")
    order = F.row_number().over(W.partitionBy("document_id").orderBy("place"))
    return splitting.extract_answers(parts).select("document_id", order.alias("place"), "question_number", "answer")


@query()
def similar_vectors(spark, sf_dir):
    """The ten nearest vectors of every hundredth one, among all."""
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vectors.neighbours(rows, rows.where("vec_id % 100 = 0"), "vec_id", "embedding").select("query", "vec_id", "rank")


@query("""WITH RECURSIVE e AS (SELECT DISTINCT 'o' || l_orderkey AS s, 'p' || l_partkey AS t FROM lineitem UNION ALL SELECT DISTINCT 'p' || l_partkey, 's' || l_suppkey FROM lineitem
        UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation),
    w AS (SELECT DISTINCT s AS start, s AS node, 0 AS steps FROM e WHERE s IN (SELECT 'o' || o_orderkey FROM orders WHERE o_orderkey % 50 = 0) UNION SELECT start, t, steps + 1 FROM w JOIN e ON s = node)
    SELECT start, node, min(steps)::int AS steps FROM w GROUP BY ALL""")
def lineage_walk(spark, sf_dir):
    """What every fiftieth order rests on, over parts, suppliers and nations, as a candidate rests on blocks, calls and files."""
    edge = lambda df, s, a, t, b: df.select(F.concat(F.lit(s), a).alias("source"), F.concat(F.lit(t), b).alias("target"))
    items, orders = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders")
    edges = edge(items, "o", "l_orderkey", "p", "l_partkey").union(edge(items, "p", "l_partkey", "s", "l_suppkey")).union(edge(read(spark, sf_dir, "supplier"), "s", "s_suppkey", "n", "s_nationkey")).union(edge(read(spark, sf_dir, "nation"), "n", "n_nationkey", "r", "n_regionkey"))
    starts = orders.where("o_orderkey % 50 = 0").select(F.concat(F.lit("o"), "o_orderkey").alias("start"))
    return graph.reached(edges, starts.join(edges.select(F.col("source").alias("start")).distinct(), "start", "left_semi"))


_TAIL = "exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(p) + (n - i) * ln(1 - p))"


@query(f"""WITH RECURSIVE g AS (SELECT doc_id, lang AS want FROM documents JOIN labels USING (doc_id) WHERE quality = 1),
    b AS (SELECT doc_id, lang AS ans FROM documents WHERE n_chars >= 200), a AS (SELECT doc_id, CASE WHEN doc_id % 97 = 0 THEN 'xx' ELSE lang END AS ans FROM documents WHERE n_chars >= 300),
    j AS (SELECT want, b.ans AS old, a.ans AS new FROM g LEFT JOIN b USING (doc_id) LEFT JOIN a USING (doc_id)),
    c AS (SELECT count(new) AS n, count(*) FILTER (new = want) AS k, count(*) FILTER (old = want AND new IS DISTINCT FROM want) AS lost, count(*) FILTER (new = want AND old IS DISTINCT FROM want) AS won, count(*) FILTER (new <> want AND NOT coalesce(old <> want, false)) AS wrong_new FROM j),
    lo AS (SELECT 0 AS step, 0.0::double AS l, 1.0::double AS h FROM c UNION ALL SELECT step + 1, CASE WHEN t > 0.025 THEN l ELSE p END, CASE WHEN t > 0.025 THEN p ELSE h END FROM (SELECT *, (SELECT sum({_TAIL}) FROM (SELECT unnest(range(k, n + 1)) AS i, n FROM c)) AS t FROM (SELECT *, (l + h) / 2 AS p FROM lo)) WHERE step < 60),
    hi AS (SELECT 0 AS step, 0.0::double AS l, 1.0::double AS h FROM c UNION ALL SELECT step + 1, CASE WHEN t < 0.025 THEN l ELSE p END, CASE WHEN t < 0.025 THEN p ELSE h END FROM (SELECT *, (SELECT sum({_TAIL}) FROM (SELECT unnest(range(0, k + 1)) AS i, n FROM c)) AS t FROM (SELECT *, (l + h) / 2 AS p FROM hi)) WHERE step < 60),
    m AS (SELECT least(1, 2 * sum(exp(lgamma(s + 1) - lgamma(i + 1) - lgamma(s - i + 1) - s * ln(2)))) AS chance FROM (SELECT lost + won AS s, unnest(range(0, least(lost, won) + 1)) AS i FROM c))
    SELECT n AS accepted, k AS correct, lost, won, wrong_new, round((SELECT l FROM lo WHERE step = 60), 6) AS precision_low, round((SELECT l FROM hi WHERE step = 60), 6) AS precision_high, round(chance, 6) AS chance, wrong_new > 0 OR (lost > won AND chance < 0.05) AS refused FROM c, m""")
def gold_regression(spark, sf_dir):
    """A run of a changed threshold, and some wrong answers, against the run before it, on the labelled documents."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    gold = docs.join(labels.where("quality = 1"), "doc_id").select("doc_id", F.col("lang").alias("answer"))
    before = docs.where("n_chars >= 200").select("doc_id", F.col("lang").alias("answer"))
    after = docs.where("n_chars >= 300").select("doc_id", F.when(F.col("doc_id") % 97 == 0, "xx").otherwise(F.col("lang")).alias("answer"))
    return report.gold_regression(before, after, gold, "doc_id")


_XML = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:m="http://schemas.openxmlformats.org/officeDocument/2006/math"'
_LABELS = f'<w:numbering {_XML}><w:abstractNum w:abstractNumId="0"><w:lvl w:ilvl="0"><w:start w:val="1"/><w:numFmt w:val="chineseCounting"/><w:lvlText w:val="%1、"/></w:lvl></w:abstractNum><w:num w:numId="1"><w:abstractNumId w:val="0"/></w:num></w:numbering>'


def _packed(body: Column) -> Column:
    """Each body as a .docx package; an empty one as no package."""

    @F.pandas_udf("binary")
    def packages(bodies: pd.Series) -> pd.Series:
        return bodies.map(lambda body: _package(body) if body else b"no package")

    return packages(body)


def _package(body: str) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {_XML}><w:body>{body}</w:body></w:document>")
        z.writestr("word/numbering.xml", _LABELS)
    return out.getvalue()


_NUMERALS = "CASE WHEN k < 10 THEN substr('一二三四五六七八九', k, 1) ELSE '十' END"


@query(f"""WITH t AS (SELECT *, sum((role = 'user')::int) OVER (PARTITION BY conv_id ORDER BY turn)::bigint AS k FROM conversations WHERE conv_id % 11 > 0),
    b AS (SELECT conv_id, turn, 0 AS part, 'paragraph' AS type, CASE WHEN role = 'user' THEN {_NUMERALS} || '、' END AS label, CASE role WHEN 'user' THEN 'x$^{{' || turn || '}}$ is a-b: ' WHEN 'system' THEN 'head & <' || turn || '>' END AS text, NULL AS latex FROM t WHERE role <> 'assistant'
        UNION ALL SELECT conv_id, turn, 1, 'formula', NULL, NULL, CASE turn % 3 WHEN 0 THEN '\\frac{{' || turn || '}}{{2}}' WHEN 1 THEN '\\sqrt{{' || turn || '}}' ELSE '{{x}}_{{' || turn || '}}' END FROM t WHERE role = 'user'
        UNION ALL SELECT conv_id, turn, 2, 'paragraph', NULL, 'so', NULL FROM t WHERE role = 'user'
        UNION ALL SELECT conv_id, turn, 0, 'table', NULL, CASE WHEN turn % 4 = 1 THEN '| a' || turn || ' | ×' || ' |' || chr(10) || '|---|---|' ELSE '<table><tr><td colspan="2">w' || turn || '</td></tr></table>' END, NULL FROM t WHERE role = 'assistant')
    SELECT conv_id::varchar || '.docx' AS source_file, 'ok' AS status, (row_number() OVER (PARTITION BY conv_id ORDER BY turn, part) - 1)::int AS ord, type, label, text, latex FROM b
    UNION ALL SELECT DISTINCT conv_id::varchar || '.docx', 'parse_failed', NULL, NULL, NULL, NULL, NULL FROM conversations WHERE conv_id % 11 = 0""")
def docx_blocks(spark, sf_dir):
    """Conversations as .docx packages, taken apart: numbered lines with scripts, formulas between texts, tables plain and merged; some are no package."""
    run = lambda *inner: F.concat(F.lit("<w:r>"), *inner, F.lit("</w:r>"))
    text = lambda c: F.concat(F.lit('<w:t xml:space="preserve">'), c, F.lit("</w:t>"))
    turn = F.col("turn").cast("string")
    m = lambda tag, *inner: F.concat(F.lit(f"<m:{tag}>"), *inner, F.lit(f"</m:{tag}>"))
    said = lambda c: m("r", m("t", c))
    formula = F.when(F.col("turn") % 3 == 0, m("f", m("num", said(turn)), m("den", said(F.lit("2"))))).when(F.col("turn") % 3 == 1, m("rad", m("deg"), m("e", said(turn)))).otherwise(m("sSub", m("e", said(F.lit("x"))), m("sub", said(turn))))
    high = F.lit('<w:rPr><w:vertAlign w:val="superscript"/></w:rPr>')
    asked = F.concat(F.lit('<w:p><w:pPr><w:numPr><w:ilvl w:val="0"/><w:numId w:val="1"/></w:numPr></w:pPr>'), run(text(F.lit("x"))), run(high, text(turn)), run(text(F.lit(" is a"))), run(F.lit("<w:noBreakHyphen/>")), run(text(F.lit("b: "))), m("oMath", formula), run(text(F.lit("so"))), F.lit("</w:p>"))
    cell = lambda props, c: F.concat(F.lit(f"<w:tc>{props}<w:p>"), c, F.lit("</w:p></w:tc>"))
    plain = F.concat(cell("", run(text(F.concat(F.lit("a"), turn)))), cell("", run(F.lit('<w:sym w:font="Symbol" w:char="F0B4"/>'))))
    merged = cell('<w:tcPr><w:gridSpan w:val="2"/></w:tcPr>', run(text(F.concat(F.lit("w"), turn))))
    told = F.concat(F.lit("<w:tbl><w:tr>"), F.when(F.col("turn") % 4 == 1, plain).otherwise(merged), F.lit("</w:tr></w:tbl>"))
    head = F.concat(F.lit("<w:p>"), run(text(F.concat(F.lit("head &amp; &lt;"), turn, F.lit("&gt;")))), F.lit("</w:p>"))
    body = F.when(F.col("role") == "user", asked).when(F.col("role") == "assistant", told).otherwise(head)
    bodies = blocks.joined_in_order(read(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("ord"), body.alias("body")), "conv_id", F.col("body"), "")
    packages = bodies.select(F.concat(F.lit("in/"), "conv_id", F.lit(".docx")).alias("path"), _packed(F.when(F.col("conv_id") % 11 > 0, F.col("text")).otherwise("")).alias("content"))
    each = docx.taken_apart(packages).select("source_file", "status", F.explode_outer("parts").alias("p"))
    shown = F.when(F.col("p.type") != "formula", F.col("p.raw_text"))
    return each.select("source_file", "status", "p.ord", "p.type", F.col("p.resolved_label").alias("label"), shown.alias("text"), "p.latex")


@query(f"""SELECT doc_id, CASE WHEN doc_id % 5 = 1 OR lang NOT IN ({_LISTED}) THEN 'LANGUAGE_UNRESOLVED' WHEN doc_id % 5 BETWEEN 2 AND 4 AND doc_id % 7 > 0 OR trim(text) = '' THEN 'SCHEMA_VALIDATION_FAILED' END AS reason_code FROM documents""")
def contract_gate(spark, sf_dir):
    """Final records of documents: one in five has a language that is no code, others a grade that is not its level's, an unlisted type, or a digest of another text."""
    k, whole = F.col("doc_id") % 5, F.col("doc_id") % 7 == 0
    info = static_info(F.when((k == 4) & ~whole, F.concat("text", F.lit("x"))).otherwise(F.col("text")))
    made = {
        "text_question": F.col("text"), "is_pic_included": includes_picture(F.col("text")), "text_answer": F.lit("A"), "text_grade_level": F.lit("初中一年级"), "text_grade": F.when((k == 2) & ~whole, "高中").otherwise("初中"),
        "question_type": F.when((k == 3) & ~whole, "作文").otherwise("选择题"), "language": F.when(k == 1, "english").otherwise(iso_language(F.col("lang"))), "static_info": info, "text_paper": F.lit("卷"),
    }
    docs = read(spark, sf_dir, "documents").withColumns(made)
    docs = docs.withColumns({f: with_default(F.lit(None).cast("string"), f) for f in FINAL_FIELDS if f not in made})
    return gates.outcome(docs, gates.contract_failures()).select("doc_id", "reason_code")


@query("""SELECT conv_id || ':' || turn AS question_id, CASE WHEN turn % 5 IN (0, 4) THEN 'PASS' ELSE 'FAIL' END AS verdict, CASE WHEN turn % 5 IN (0, 4) THEN 0.99::double END AS score FROM conversations""")
def verifier_verdicts(spark, sf_dir):
    """Verdicts from the ledger: whole ones, one with a text of its own, one that cites out of order, one that is no JSON, and one with fewer citations."""
    turn, service = F.col("turn"), SimpleNamespace(name="judge", model="1")
    pairs = read(spark, sf_dir, "conversations").select(F.concat_ws(":", "conv_id", "turn").alias("question_id"), F.lit("a").alias("answer_id"), F.col("text").alias("question"), F.lit("A").alias("answer"), F.array(F.lit("b1"), F.lit("b2")).alias("block_ids"), "turn")
    said = lambda cited, more="": F.lit(f'{{"verdict": "PASS", "score": 0.99, "reason": "r", "cited_blocks": {cited}{more}}}')
    content = F.when(turn % 5 == 0, said('["b1", "b2"]')).when(turn % 5 == 1, said('["b1"]', ', "answer": "B"')).when(turn % 5 == 2, said('["b2", "b1"]')).when(turn % 5 == 3, "PASS").otherwise(said('["b2"]'))
    # equal questions are one call: their ids go along, so that each has its own row here
    asked = pairs.withColumn("question", F.concat_ws(" ", "question", "question_id"))
    payload = F.encode(F.concat(F.lit("judge\n"), F.to_json(F.struct("question", "answer", "block_ids"))), "UTF-8")
    key = cache_key(F.sha2(payload, 256), F.lit("judge"), F.lit("1"), F.lit("v"), F.lit("answer_verify"))
    absent = {c: F.lit(None).cast(t) for c, t in (("latency", "double"), ("tokens", "long"), ("cost", "double"), ("raw_score", "decimal(9,6)"), ("error", "string"))}
    ledger = asked.select(key.alias("cache_key"), F.lit("judge").alias("provider"), F.lit("1").alias("model"), F.lit("r").alias("request_id"), F.lit("v").alias("prompt_version"), F.lit("answer_verify").alias("task"), content.alias("content"), *[v.alias(k) for k, v in absent.items()])
    found, _ = providers.verdicts(asked.drop("turn"), service, ledger, "judge", "v", 4)
    return found.select("question_id", "verdict", F.col("verifier_score").cast("double").alias("score"))


_FREQUENT = ", ".join(f"len(list_filter(w, lambda x: x IN {words!r})) AS {lang}" for lang, words in SPOKEN.items())


@query(f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    c AS (SELECT doc_id, len(regexp_extract_all(t, '[一-龥]')) AS han, len(regexp_extract_all(t, '[\u3041-\u3096\u30a1-\u30fa]')) AS kana, len(regexp_extract_all(t, '[가-힣]')) AS hangul, len(regexp_extract_all(t, '[A-Za-z]{{2,}}')) AS latin, regexp_extract_all(lower(t), '\\p{{L}}+') AS w FROM d),
    s AS (SELECT *, {_FREQUENT} FROM c)
    SELECT doc_id, CASE WHEN hangul > han + kana AND hangul > latin THEN 'ko' WHEN han + kana > latin AND kana * 10 >= han + kana THEN 'ja' WHEN han + kana > latin THEN 'zh' WHEN latin = 0 THEN NULL
      WHEN en > greatest(fr, de, es) THEN 'en' WHEN fr > greatest(en, de, es) THEN 'fr' WHEN de > greatest(en, fr, es) THEN 'de' WHEN es > greatest(en, fr, de) THEN 'es' END AS language FROM s""")
def spoken_language(spark, sf_dir):
    """The language of each document, by scripts and frequent words."""
    return read(spark, sf_dir, "documents").select("doc_id", main_language(language_signs(F.col("text"))).alias("language"))
