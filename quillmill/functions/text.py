"""Text, hash and metadata functions on columns."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quillmill.schemas import FINAL_FIELDS

#: Aliases of enumerated values: fixed values.
ALIASES = {
    "text_grade_level": {"初一": "初中一年级", "初二": "初中二年级", "初三": "初中三年级", "高一": "高中一年级", "高二": "高中二年级", "高三": "高中三年级", "七年级": "初中一年级", "八年级": "初中二年级", "九年级": "初中三年级"},
    "question_type": {"单选题": "选择题", "多选题": "选择题", "单项选择题": "选择题", "判断": "判断题", "填空": "填空题", "解答题": "问答题", "简答题": "问答题"},
    "text_course": {"思想政治": "政治", "道德与法治": "政治", "English": "英语"},
    "entrance_exam_type": {"小升初考试": "小升初", "中考真题": "中考", "高考真题": "高考"},
}
#: The two-letter codes of ISO 639-1: fixed values.
LANGUAGES = tuple("""
    aa ab ae af ak am an ar as av ay az ba be bg bh bi bm bn bo br bs ca ce ch co cr cs cu cv cy da de dv dz ee el en eo es et eu fa ff fi fj fo fr fy
    ga gd gl gn gu gv ha he hi ho hr ht hu hy hz ia id ie ig ii ik io is it iu ja jv ka kg ki kj kk kl km kn ko kr ks ku kv kw ky la lb lg li ln lo lt lu lv
    mg mh mi mk ml mn mr ms mt my na nb nd ne ng nl nn no nr nv ny oc oj om or os pa pi pl ps pt qu rm rn ro ru rw sa sc sd se sg si sk sl sm sn so sq sr ss
    st su sv sw ta te tg th ti tk tl tn to tr ts tt tw ty ug uk ur uz ve vi vo wa wo xh yi yo za zh zu
""".split())


#: Signs other than those that composing leaves as they are, whatever stands beside them: Latin, Cyrillic and punctuation without marks, Kana, Chinese, whole Hangul syllables, wide forms.
MAY_COMPOSE = r"[^\x00-\u02ff\u0400-\u0482\u048a-\u052f\u2010-\u2027\u2030-\u205e\u3000-\u3029\u3041-\u3096\u30a1-\u30fa\u30fc-\u30fe\u3400-\u4dbf\u4e00-\u9fff\uac00-\ud7a3\uff01-\uff60]"


@F.pandas_udf(StringType())
def _composed(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t), na_action="ignore")


def nfc(text: Column) -> Column:
    """Composed characters. Only texts that composing may change go to Python, so its batches do not hold whole tables' texts."""
    may = (F.octet_length(text) > F.char_length(text)) & text.rlike(MAY_COMPOSE)  # ASCII first: it is told quickly
    return F.coalesce(_composed(F.when(may, text)), text)


def canonical(text: Column) -> Column:
    """Composed characters, line feeds, no white space at the ends, at most one blank line in a row."""
    lined = F.regexp_replace(nfc(text), "\r\n?", "\n")
    return F.regexp_replace(F.regexp_replace(lined, r"(?U)^\s+|\s+$", ""), r"\n{3,}", "\n\n")


def slim_md5(text: Column) -> Column:
    """Version 1 of the question hash: digits, formulas and image references count as they are."""
    return F.md5(F.encode(canonical(text), "UTF-8"))


def asset_id(content: Column) -> Column:
    return F.concat(F.lit("img_"), F.substring(F.sha2(content, 256), 1, 16))


def cache_key(content_hash: Column, provider: Column, model: Column, prompt: Column, task: Column) -> Column:
    """Any other version gives another key. Fields are parted by a character that none of them has."""
    return F.sha2(F.concat_ws("\x00", *[F.coalesce(c.cast("string"), F.lit("")) for c in (content_hash, provider, model, prompt, task)]), 256)


def normalized_enum(value: Column, field: str) -> Column:
    """The listed value of an alias; white space at the ends does not count."""
    bare = F.trim(value)
    pairs = ALIASES.get(field, {})
    return F.coalesce(*[F.when(bare == k, F.lit(v)) for k, v in pairs.items()], bare) if pairs else bare


def grade_of(level: Column) -> Column:
    return F.coalesce(*[F.when(level.startswith(g), F.lit(g)) for g in ("小学", "初中", "高中")], F.lit("未知"))


def with_default(value: Column, field: str) -> Column:
    """An absent or blank value becomes the field's default; null where the contract has none."""
    given = F.nullif(F.trim(value), F.lit(""))
    default = FINAL_FIELDS[field]
    return given if default is None else F.coalesce(given, F.lit(default))


def iso_language(value: Column) -> Column:
    """A listed lower-case two-letter code, or null."""
    code = F.lower(F.regexp_extract(F.trim(value), r"^([A-Za-z]{2})(?:[-_].*)?$", 1))
    return F.when(code.isin(*LANGUAGES), code)


# Frequent words of languages in Latin letters; none is in two lists.
SPOKEN = {
    "de": ("der", "die", "und", "den", "von", "zu", "das", "sich", "mit", "auf", "ist", "nicht"),
    "en": ("the", "of", "and", "to", "is", "that", "for", "it", "was", "with", "are", "this"),
    "es": ("el", "los", "del", "las", "por", "con", "una", "su", "es", "para", "y", "se"),
    "fr": ("le", "les", "des", "et", "est", "une", "qui", "dans", "pour", "pas", "du", "au"),
}


def language_signs(text: Column) -> dict[str, Column]:
    """Counts that tell a language: signs of the Chinese, Japanese and Korean scripts, words of Latin letters, and of these the frequent ones of each of SPOKEN."""
    value = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(F.lower(value), F.lit(r"\p{L}+"), F.lit(0))
    scripts = {"han": "[一-龥]", "kana": "[\u3041-\u3096\u30a1-\u30fa]", "hangul": "[가-힣]", "latin": "[A-Za-z]{2,}"}
    return {**{k: F.regexp_count(value, F.lit(v)) for k, v in scripts.items()}, **{k: F.size(F.filter(words, _listed(v))) for k, v in SPOKEN.items()}}


def _listed(words: tuple[str, ...]):
    return lambda w: w.isin(*words)


def main_language(signs: dict[str, Column]) -> Column:
    """The language that counts (or their sums) tell; null where they do not.

    Kana on at least a tenth of Chinese and Japanese signs tell ja, else these signs zh, Hangul ko, each where there are more than Latin words;
    of Latin words the language with more frequent words than any other.
    """
    east = signs["han"] + signs["kana"]
    latin = F.lit(None).cast("string")
    for k in SPOKEN:
        beaten = F.lit(True)
        for other in SPOKEN:
            if other != k:
                beaten = beaten & (signs[k] > signs[other])
        latin = F.when(beaten, k).otherwise(latin)
    return F.when((signs["hangul"] > east) & (signs["hangul"] > signs["latin"]), "ko").when((east > signs["latin"]) & (signs["kana"] * 10 >= east), "ja").when(east > signs["latin"], "zh").when(signs["latin"] > 0, latin)


def static_info(question: Column, **fields: Column) -> Column:
    """The JSON text of the static information, with keys in order."""
    values = {"copyright": F.lit(""), "slim_md5_version": F.lit("v1"), "slim_question_md5": slim_md5(question), **fields}
    return F.to_json(F.struct(*[values[k].alias(k) for k in sorted(values)]), {"ignoreNullFields": "false"})


def includes_picture(question: Column) -> Column:
    return F.coalesce(question.contains('<img src="image/'), F.lit(False)).cast("int")
