"""Documents: features, class by rules, metadata with their sources, and exam clusters that avoid doubtful merges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmill.functions.text import normalized_enum
from quillmill.operators.graph import cut, groups
from quillmill.operators.splitting import question_number
from quillmill.schemas import COURSES, DOCUMENT_CLASSES, ENTRANCE_EXAMS, GRADE_LEVELS

_ANSWER_HEAD = r"^\s*(【?参考答案|【?答案(与|及|和)?(解析)?】?\s*[:：]?\s*$|.{0,30}(参考答案|答案与解析|答案及解析)\s*$)"
_ANSWER_MARK = r"【答案】|^\s*答案\s*[:：]|【解析】|解析\s*[:：]"
_COMPACT = r"^\s*\d{1,3}\s*[.．、)）]\s*[A-D]{1,4}(\s|$|[,，;；])"
_OPTION = r"(^|\s)[A-D]\s*[.．、]"
#: What file names of one exam differ in: question and answer copies, versions.
_ROLE_WORDS = r"参考答案|答案与解析|答案及解析|答案解析|答案|解析版|原卷版|解析|试题卷|试卷|试题|原卷|word版|[\s_\-—()（）【】\[\].,，。]+"
#: Sources of a metadata value, best first.
SOURCES = ("document", "file_name", "title", "cluster", "model")
FIELDS = ("course", "level", "year", "city", "exam")


def _bare(blocks: DataFrame) -> DataFrame:
    return blocks.where(~F.col("type").isin("header", "footer", "noise_candidate"))


def sections(blocks: DataFrame) -> DataFrame:
    """blocks with in_answers: whether a heading of answers stands before the block or is it."""
    head = F.coalesce(F.col("raw_text").rlike(_ANSWER_HEAD), F.lit(False))
    return blocks.withColumn("in_answers", F.max(head).over(W.partitionBy("document_id").orderBy("ord")))


def features(blocks: DataFrame) -> DataFrame:
    """A row for each document: counts and shares of numbered, option and answer blocks, and number sequences."""
    body = sections(_bare(blocks)).withColumn("number", question_number(F.col("resolved_label"), F.col("raw_text")))
    yes = lambda c: F.coalesce(c, F.lit(False))
    marked, compact = yes(F.col("raw_text").rlike(_ANSWER_MARK)), yes(F.col("raw_text").rlike(_COMPACT))
    answer = marked | compact | (F.col("in_answers") & F.col("number").isNotNull())
    numbers = lambda c: F.transform(F.array_sort(F.collect_list(F.when(c & F.col("number").isNotNull(), F.struct("ord", "number")))), lambda x: x["number"])
    return body.groupBy("document_id").agg(
        F.count("*").alias("n_blocks"), F.count_if(F.col("number").isNotNull() & ~answer).alias("n_questions"), F.count_if(yes(F.col("raw_text").rlike(_OPTION)) & ~F.col("in_answers")).alias("n_options"), F.count_if(answer).alias("n_answers"),
        F.bool_or("in_answers").alias("has_answer_heading"), F.round(F.avg(answer.cast("double")), 6).alias("answer_density"), numbers(~answer).alias("question_numbers"), numbers(answer).alias("answer_numbers"),
    )


def classify(counted: DataFrame) -> DataFrame:
    """counted with document_class, by rules alone; what no rule tells stays UNKNOWN."""
    asks, tells = F.col("n_questions") > 0, F.col("n_answers") > 0
    kind = F.when(asks & tells & F.col("has_answer_heading"), "QUESTION_AND_ANSWER").when(asks & tells, "MIXED").when(tells, "ANSWER").when(asks, "QUESTION").otherwise("UNKNOWN")
    return counted.withColumn("document_class", kind)


def cited_in_order(cited: Column, ids: Column) -> Column:
    """Whether ids are cited, all are there, and they keep the order of the source."""
    places = F.transform(cited, lambda c: F.array_position(ids, c))
    return F.coalesce((F.size(cited) > 0) & ~F.array_contains(places, 0) & (places == F.array_sort(places)), F.lit(False))


def fused_class(rule: Column, model: Column, cited: Column, ids: Column) -> Column:
    """A model's class counts only where the rules tell none, the class is a listed one, and its evidence is there."""
    return F.when((rule == "UNKNOWN") & model.isin(*DOCUMENT_CLASSES) & cited_in_order(cited, ids), model).otherwise(rule)


def _found(text: Column) -> dict[str, Column]:
    """What a line says of each field; null where it says nothing."""
    some = lambda pattern, group=1: F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), pattern, group), F.lit(""))
    levels = "|".join([*(x for x in GRADE_LEVELS if x != "未知"), "[七八九]年级", "[初高][一二三](?![一-龥]?年级)"])
    courses = "|".join(c for c in COURSES if c != "未知")
    return {
        "course": some(rf"({courses})"), "level": normalized_enum(some(rf"({levels})"), "text_grade_level"), "year": some(r"(?<!\d)((?:19|20)\d{2})(?!\d)"),
        "city": some(r"(?:^|[^一-龥]|省|年)([一-龥&&[^年省]]{2,4}?)市"), "exam": some("(" + "|".join(e for e in ENTRANCE_EXAMS if e != "未知") + ")"),
    }


def metadata_values(documents: DataFrame, blocks: DataFrame) -> DataFrame:
    """(document_id, field, value, source, score): what the first lines, the file name and the headers say."""
    first = blocks.where("type = 'paragraph' AND raw_text IS NOT NULL AND ord < 3").select("document_id", F.lit("document").alias("source"), F.col("raw_text").alias("line"), "ord")
    heads = blocks.where("type = 'header' AND raw_text IS NOT NULL").select("document_id", F.lit("title").alias("source"), F.col("raw_text").alias("line"), "ord")
    names = documents.select("document_id", F.lit("file_name").alias("source"), F.col("source_file").alias("line"), F.lit(0).alias("ord"))
    lines = first.unionByName(heads).unionByName(names)
    said = F.array(*[F.struct(F.lit(k).alias("field"), v.alias("value")) for k, v in _found(F.col("line")).items()])
    each = lines.select("document_id", "source", "ord", F.explode(said).alias("f")).where("f.value IS NOT NULL")
    score = F.when(F.col("source") == "document", "0.99").when(F.col("source") == "file_name", "0.97").otherwise("0.95").cast("decimal(9,6)")
    return each.groupBy("document_id", F.col("f.field").alias("field"), "source").agg(F.min_by("f.value", F.struct("ord", "f.value")).alias("value")).select("document_id", "field", "value", "source", score.alias("score"))


def prioritised(values: DataFrame, key: str) -> DataFrame:
    """(key, field, value, source, score): of each field the value of the best source; ties go to the smaller value."""
    rank = F.array_position(F.array(*map(F.lit, SOURCES)), F.col("source"))
    best = F.min_by(F.struct("value", "source", "score"), F.struct(rank, "value"))
    return values.where(F.col("value").isNotNull()).groupBy(key, "field").agg(best.alias("b")).select(key, "field", "b.*")


def wide(values: DataFrame, key: str) -> DataFrame:
    """A row for each key, a column for each field."""
    return values.groupBy(key).agg(*[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in FIELDS])


def exam_key(name: Column) -> Column:
    """A file name or title without its ending and what sets question and answer copies apart; null if little is left."""
    bare = F.regexp_replace(F.lower(F.regexp_replace(name, r"\.[A-Za-z0-9]+$", "")), _ROLE_WORDS, "")
    return F.when(F.char_length(bare) >= 4, bare)


#: What may make two documents one exam. Each rule is a set of evidence that both have alike; none of it may be absent.
RULES = (("file",), ("title",), ("sketch", "course", "year"), ("course", "level", "year", "numbers"), ("meaning", "course", "year"))
#: MinHash bands of a title's pairs of characters, and minima in each: titles alike to 0.8 share one with a chance of 0.98.
_BANDS, _MINIMA = 4, 2


def title_sketch(title: Column) -> Column:
    """Keys of a title, by its pairs of characters; titles that are much alike share one. Null below four characters."""
    bare = exam_key(title)
    pairs = F.transform(F.sequence(F.lit(1), F.char_length(bare) - 1), lambda i: F.substring(bare, i, F.lit(2)))

    def least(seed: int) -> Column:
        return F.array_min(F.transform(pairs, lambda p: F.xxhash64(p, F.lit(seed)))).cast("string")

    band = lambda b: F.concat_ws("-", F.lit(b), *[least(b * _MINIMA + k) for k in range(_MINIMA)])
    return F.when(bare.isNotNull(), F.array(*[band(b) for b in range(_BANDS)]))


def _evidence_keys(documents: DataFrame) -> DataFrame:
    """(document_id, key): a key for each rule (and band of a sketch) whose evidence the document has."""
    told = lambda c: F.when(F.size(c) > 0, F.array_join(F.array_sort(F.array_distinct(c)), ","))
    one = {f: F.col(f) for f in FIELDS} | {"file": exam_key(F.col("source_file")), "title": exam_key(F.col("title")), "numbers": F.coalesce(told(F.col("question_numbers")), told(F.col("answer_numbers")))}
    several = {"sketch": title_sketch(F.col("title")), "meaning": F.array(F.col("meaning")) if "meaning" in documents.columns else F.lit(None).cast("array<string>")}

    def of_rule(rule: tuple[str, ...]) -> Column:
        lone, many = [one[r].cast("string") for r in rule if r in one], [several[r] for r in rule if r in several]
        # file names and titles are of one kind: the file name of one may be the title of another
        name = F.lit("name" if rule in (("file",), ("title",)) else "+".join(rule))
        whole = lambda *more: F.concat_ws("\x1f", name, *lone, *more)
        sound = reduce(lambda x, y: x & y, [c.isNotNull() for c in lone])
        return F.when(sound, F.transform(many[0], lambda v: whole(v)) if many else F.array(whole()))

    keys = [of_rule(rule) for rule in RULES]
    none = F.array().cast("array<string>")
    return documents.select("document_id", F.explode_outer(F.concat(*[F.coalesce(k, none) for k in keys])).alias("key"))


def clusters(documents: DataFrame) -> DataFrame:
    """(document_id, cluster_id) from document_id, source_file, title, document_class, question_numbers, answer_numbers, the fields and, where there, meaning.

    Documents that share the evidence of a rule of RULES, directly or over others, may be one exam. What cannot be one
    exam is parted from the rest, and the rest stays together:
    documents that say different things of a field part by what they say, and one that says nothing of it leaves, as it could be either's;
    of several documents with questions, or several with answers, those stay together two by two whose question numbers are the
    same and are nobody else's, and the others leave; and an answer document leaves if most of its answers have no question number to go to.
    A document that leaves is a cluster of its own. No group is gathered and no pairs are made. cluster_id is exam_ and the smallest document in it.
    """
    keys = _evidence_keys(documents)
    placed = documents.join(groups(keys, "document_id", "key"), "document_id")
    said = placed.select("group_id", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in FIELDS])).alias("f")).where("f.value IS NOT NULL")
    differ = said.groupBy("group_id", "f.field").agg(F.min("f.value").alias("low"), F.max("f.value").alias("high")).where("low <> high").groupBy("group_id").agg(F.collect_set("field").alias("differ"))
    parted = placed.join(differ, "group_id", "left").withColumn("differ", F.coalesce("differ", F.array().cast("array<string>")))
    side, silent = [], F.lit(False)
    for f in FIELDS:
        here = F.array_contains("differ", f)
        side.append(F.when(here, F.concat(F.lit(f"{f}="), F.col(f).cast("string"))))
        silent = silent | (here & F.col(f).isNull())
    label = F.when(silent, F.concat(F.lit("alone="), F.col("document_id"))).otherwise(F.concat_ws("\x1f", *side))
    # what parts documents may have cut the chain between others too
    apart = cut(parted.select("document_id", label.alias("label")))
    again = keys.join(apart, "document_id").select("document_id", F.when(F.col("key").isNotNull(), F.concat_ws("\x1e", "label", "key")).alias("key"))
    placed = documents.join(groups(again, "document_id", "key"), "document_id")
    asks, tells = F.col("document_class").isin("QUESTION", "QUESTION_AND_ANSWER", "MIXED"), F.col("document_class").isin("ANSWER", "QUESTION_AND_ANSWER", "MIXED")
    numbers = F.when(asks, F.array_join(F.array_sort(F.array_distinct("question_numbers")), ",")).when(tells, F.array_join(F.array_sort(F.array_distinct("answer_numbers")), ","))
    placed = placed.withColumns({"asks": asks, "tells": tells, "sequence": numbers})
    roles = placed.groupBy("group_id").agg(((F.count_if("asks") > 1) | (F.count_if("tells") > 1)).alias("crowded"))
    partners = placed.where("sequence <> ''").groupBy("group_id", "sequence").agg(((F.count_if("asks") == 1) & (F.count_if("tells") == 1)).alias("couple"))
    placed = placed.join(roles, "group_id").join(partners, ["group_id", "sequence"], "left")
    home = F.when(~F.col("crowded"), F.col("group_id")).when(F.col("couple"), F.concat_ws("\x1f", "group_id", "sequence")).otherwise(F.concat(F.lit("alone="), F.col("document_id")))
    placed = cut(placed.select("document_id", "asks", "tells", "question_numbers", "answer_numbers", home.alias("home")))
    every = lambda c: F.array_distinct(F.flatten(F.collect_set(c)))
    told = placed.groupBy("home").agg(every("question_numbers").alias("qs"), F.count("*").alias("n"))  # one exam: a home has one document of questions at most
    lost = F.col("tells") & ~F.col("asks") & (F.col("n") > 1) & (2 * F.size(F.array_except("answer_numbers", "qs")) > F.size("answer_numbers"))
    settled = placed.join(told, "home").select("document_id", F.when(lost, F.concat(F.lit("alone="), F.col("document_id"))).otherwise(F.col("home")).alias("home"))
    first = settled.groupBy("home").agg(F.min("document_id").alias("first"))
    return settled.join(first, "home").select("document_id", F.concat(F.lit("exam_"), "first").alias("cluster_id"))


def from_cluster(values: DataFrame, placed: DataFrame) -> DataFrame:
    """values and, for each document, what others of its cluster say, as a lower source. Clusters hold no conflicts."""
    own = values.join(placed, "document_id")
    shared = own.groupBy("cluster_id", "field").agg(F.min("value").alias("value"))
    lent = placed.join(shared, "cluster_id").select("document_id", "field", "value", F.lit("cluster").alias("source"), F.lit("0.90").cast("decimal(9,6)").alias("score"))
    return values.unionByName(lent)
