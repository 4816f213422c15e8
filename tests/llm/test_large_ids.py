"""Ids beyond 2**53 beside null ids come through every operator exactly."""

from tabscore.llm import language_crf, license_scan, near_documents, page_text, sentencepiece_codec, token_files

BIG = 2 ** 60 + 1


def ids(df, key="doc_id"):
    return sorted((r[key] for r in df.collect()), key=str)


def test_large_and_null_ids(spark, tmp_path):
    want = sorted([BIG, None, 3], key=str)
    df = spark.createDataFrame([(BIG, "the house and MIT license", "en", 1), (None, "das Haus und der Fluss", "de", None), (3, "the river", "en", BIG)],
                               "doc_id long, text string, lang string, extra long").coalesce(1)
    model = language_crf.learn(df)
    assert ids(language_crf.identify(df, model)) == want
    kept = language_crf.keep_known(df, model)
    assert ids(kept) == want and ids(kept, "extra") == sorted([1, None, BIG], key=str)
    assert ids(license_scan.scan(df)) == want
    assert ids(sentencepiece_codec.digest(df, sentencepiece_codec.default_model())) == want
    shards = token_files.write(df, str(tmp_path), token_files.default_tokenizer())
    assert ids(token_files.read_back(df, shards)) == want
    assert ids(near_documents.drop_copies(df)) == want
    pages = df.select(df.doc_id.alias("page_id"), df.text.alias("url"), df.text.alias("html"))
    assert ids(page_text.extract(pages), "page_id") == want
