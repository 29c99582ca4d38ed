from pyspark.sql import functions as F

from quillmill.functions.text import language_signs, main_language


def test_languages(spark):
    """Scripts and frequent words tell the language; what they do not tell is null."""
    rows = [("已知 x in 求", "zh"), ("次の問いに答えなさい", "ja"), ("다음 물음에 답하시오", "ko"), ("What is the sum of these?", "en"), ("Quelle est la somme des termes dans le cas", "fr"), ("Was ist die Summe der Zahlen", "de"), ("cual es el valor de los términos", "es"), ("A. B. C.", None), ("1 + 1 = 2", None), ("xyzzy plugh", None), (None, None), ("", None)]
    df = spark.createDataFrame(rows, "text string, want string").withColumn("got", main_language(language_signs(F.col("text"))))
    assert not [r for r in df.collect() if r.got != r.want]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("n_chars >= 200")
    right = docs.select((main_language(language_signs(F.col("text"))) == F.col("lang")).alias("right")).agg(F.avg(F.coalesce("right", F.lit(False)).cast("int"))).first()[0]
    assert right > 0.95
