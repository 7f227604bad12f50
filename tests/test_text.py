from pyspark.sql import functions as F

from tokenloom.functions import text as T
from tokenloom.operators import encode, profile, vocab
from tokenloom.sources.documents import clean, read_corpus_lines, read_documents, read_whole_text, sentences, write_corpus_text

JOINER = "‍"


def column(frame, name="text"):
    return [r[name] for r in frame.orderBy("doc_id").collect()]


def test_strip_removes_unicode_blanks_and_keeps_joiners(docs):
    texts = [" \t x \n", " x ", "　x　", "\x1cx\x1c", f"{JOINER}x{JOINER}"]
    assert column(clean(docs(*texts))) == ["x", "x", "x", "x", f"{JOINER}x{JOINER}"]
    assert [t.strip() for t in texts] == ["x", "x", "x", "x", f"{JOINER}x{JOINER}"]


def test_whitespace_set_is_that_of_str_strip():
    assert set(T.WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_empty_documents(docs):
    frame = clean(docs(None, "", "   ", "ab"))
    ids = {"a": 0, "b": 1}
    closed = encode.encode_documents(frame, encode.char_ids(F.col("text"), ids), 2).orderBy("doc_id").collect()
    assert [r.ids for r in closed] == [[], [], [], [0, 1, 2]]
    assert [r.len for r in closed] == [0, 0, 0, 3]
    kept = encode.encode_documents(frame, encode.char_ids(F.col("text"), ids), 2, keep_empty=True)
    assert [r.ids for r in kept.orderBy("doc_id").collect()] == [[2], [2], [2], [0, 1, 2]]


def test_character_length_counts_code_points(docs):
    texts = ["a😀b", f"ක්{JOINER}ෂ"]
    lengths = docs(*texts).select("doc_id", F.char_length("text").alias("n"))
    assert column(lengths, "n") == [3, 4]
    ids = vocab.collect_ids(vocab.char_vocab(docs(*texts)))
    assert list(ids) == sorted(set("".join(texts)))


def test_sentences_drop_long_and_empty_lines(docs):
    frame = docs("x" * 16384 + "\n\n" + "y" * 16385 + "\nz")
    rows = sentences(frame).orderBy("line_no").collect()
    assert [(r.line_no, len(r.line)) for r in rows] == [(0, 16384), (3, 1)]


def test_units_mark_words_and_part_digits(docs):
    frame = docs("ab  c12\n3d", "", "▁x")
    assert column(frame.withColumn("text", T.units(F.col("text")))) == ["▁ab ▁c 1 2 ▁ 3 d", "", "▁x"]


def test_corpus_text_round_trip(spark, docs, tmp_path):
    write_corpus_text(docs(" a\nb ", None, "  ", "c"), f"{tmp_path}/corpus")
    assert sorted(r.line for r in read_corpus_lines(spark, f"{tmp_path}/corpus").collect()) == ["a", "b", "c"]


def test_profile_counts_written_documents_and_newlines(docs):
    row = profile.corpus_profile(docs(" é ", "", "ab")).first()
    assert (row.num_rows, row.docs_written, row.total_chars) == (3, 2, 3)
    assert row.corpus_mb == (3 + 3) / 1024 / 1024


def test_split_stats_of_nothing(spark):
    empty = spark.createDataFrame([("val", 1, 0)], "split string, doc_id long, len int")
    row = profile.split_token_stats(empty).first()
    assert (row.num_rows, row.total_tokens, row.avg_tokens) == (1, 0, 0.0)


def test_whole_files_and_json_documents(spark, docs, tmp_path):
    (tmp_path / "prompt.txt").write_text("a\nb\n")
    row = read_whole_text(spark, f"{tmp_path}/prompt.txt").first()
    assert row.text == "a\nb\n" and row.doc_id.endswith("prompt.txt")
    docs("x", None).write.json(f"{tmp_path}/docs")
    assert column(read_documents(spark, f"{tmp_path}/docs", "json")) == ["x", None]
