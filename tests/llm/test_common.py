import pandas as pd
from pyspark.sql import functions as F

from feedfold.llm import common, neardup


def test_long_texts_reach_workers_in_small_batches(spark):
    """The operators that hold texts set the bound; 10,000 rows of these would be 40 MB."""
    texts = spark.range(0, 6_000, 1, 1).select("id", F.repeat(F.lit("words of "), 450).alias("text"))
    spark.conf.unset(common.BATCH_SETTING)
    neardup.resolve(texts.limit(1).selectExpr("id AS doc_id", "text"))

    def sizes(batches):
        for batch in batches:
            yield pd.DataFrame({"n": [len(batch)], "chars": [int(batch["text"].str.len().sum())]})

    found = texts.mapInPandas(sizes, "n long, chars long").collect()
    assert sum(r["n"] for r in found) == 6_000
    assert max(r["chars"] for r in found) <= common.BATCH_BYTES


def test_a_smaller_bound_stays(spark):
    spark.conf.set(common.BATCH_SETTING, "1024")
    try:
        common.bounded_batches(spark)
        assert spark.conf.get(common.BATCH_SETTING) == "1024"
    finally:
        spark.conf.unset(common.BATCH_SETTING)


def test_ids_stay_right_and_the_table_small_while_words_change():
    import public_tokenizers
    from tokenizers import Tokenizer

    from feedfold.llm import tokens

    def word(n):
        return "".join("abcdefghij"[int(d)] for d in str(n)) + ("," if n % 7 == 0 else "\n" if n % 11 == 0 else "")

    texts = [" ".join(map(word, range(at, at + 5_000))) for at in range(0, 400_000, 5_000)]
    odd = ["a \nb", "a\n b", "a \x1cb", "a  b", "Café Été,", "x!?*, Y\n\nZ. ", " lead", ""]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        whole = Tokenizer.from_file(path)
        encoder = tokens.LibraryEncoder(path)
        for at in range(0, len(texts), 2):
            encoder.ids(texts[at : at + 2])
            assert len(encoder.table) + len(encoder.table.old) < 2 * tokens.KEPT_SIZE + 50_000
        some = [*odd, texts[0][:3_000], texts[-1][-3_000:]]
        told = [tokens.packed(e.ids) for e in whole.encode_batch(some, add_special_tokens=False)]
        assert encoder.ids(some) == told
