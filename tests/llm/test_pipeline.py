"""The pipeline and its stages on odd rows: nulls, empty and long texts, repeated rows, empty tables, clashing names."""

import collections
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tripgrain.llm import decontaminate, html_text, quality_rules, simhash

CLASHING = "kept_id string, rows_of_id int, q_words int, q string, kept string, n_lines int, score string, predicted string, row string, base_failed int, leaked_id string"
SHAPE = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
EXTRA = ("k", 1, 2, "q", "kept", 3, "sc", "pr", "row", 4, "leak")
WORDS = "the of and to in is that for it was with as his on be at by had not are but from or have an they which one you were her all she there would their we him been has when who will more no if out so said".split()


def prose(n, seed):
    dice = random.Random(seed)
    return ". ".join(" ".join(dice.choice(WORDS) + dice.choice(["", "", "s", "ing"]) for _ in range(9)).capitalize() for _ in range(n // 9 + 1))


LEAK = prose(60, 900)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    texts = [(k, prose(150, k)) for k in range(40)] + [(100, None), (101, ""), (102, " \n "), (103, "x"), (104, prose(20_000, 7)), (105, "$$$ ### " * 200)]
    texts += [(106, prose(150, 3)), (106, prose(150, 3)), (107, prose(80, 800) + " " + LEAK + " " + prose(80, 801)), (None, prose(150, 500)), (None, prose(90, 802) + " " + LEAK)]
    rows = [(d, t, "en", "s", len(t or ""), *EXTRA) for d, t in texts]
    spark.createDataFrame(rows, SHAPE).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, LEAK), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(k, 1, 0) for k in range(0, 40, 2)] + [(105, 0, 0), (None, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def bag(df):
    return collections.Counter(map(tuple, df.collect()))


def test_stages_keep_the_documents_own_columns(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, tables)
        assert after.columns == docs.columns, name
        kept = bag(after)
        assert not kept - bag(docs), name  # nothing but whole rows of the stage's input
        assert bag(stage(spark, docs.where("false"), tables)) == {}, name
        sizes.append(sum(kept.values()))
        if name != "quality_classifier":  # with labels this few, the next stages get all rows
            docs = after
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    assert not ids & {100, 101, 102, 103, 105, 106, 107} and set(range(40)) <= ids  # 106 copies 3; 107 holds the leak
    texts = [r.text for r in docs.where("doc_id is null").collect()]
    assert texts == [prose(150, 500)]  # of the rows without an id, that with the leak is gone


def test_pipeline_packs_whole_texts(spark, tables):
    from tokenizers import Tokenizer

    from tripgrain.llm.queries import tokenizer_file

    pieces = corpus_pipeline.run(spark, tables).collect()
    tokenizer = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    whole = collections.defaultdict(int)
    for p in pieces:
        whole[p.doc_id] += p.length
    for doc_id in {p.doc_id for p in pieces if p.doc_id is not None}:
        assert whole[doc_id] == len(tokenizer.encode(texts[doc_id], add_special_tokens=False).ids) + 1
    assert pieces and all(p.length <= 1024 for p in pieces)


def test_operators_take_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x", "<html><body><article><p>Some text here</p></article></body></html>", "h", "r", "l", "o")], "page_id int, url string, html string, sst_host string, sst_html string, sst_low string, sst_of string")
    out = html_text.extract_text(pages).first()
    assert (out.text, out.sst_host, out.sst_html, out.sst_low, out.sst_of) == ("Some text here", "h", "r", "l", "o")
    docs = spark.createDataFrame([(1, prose(120, 1), *EXTRA), (2, prose(120, 1), *EXTRA)], f"doc_id long, text string, {CLASHING}")
    judged = quality_rules.judge_quality(docs).first()
    assert (judged.q_words, judged.q, judged.row) == (2, "q", "row") and judged.n_words > 100
    assert [tuple(r) for r in simhash.one_of_each(docs).collect()] == [tuple(docs.first())]
    items = spark.createDataFrame([(1, LEAK)], "item_id int, text string")
    assert bag(decontaminate.drop_leaks(docs, items)) == bag(docs)


def test_the_plain_ball_finds_the_same_components(spark):
    dice = random.Random(4)
    prints = [dice.getrandbits(64) for _ in range(25)]
    prints += [p ^ sum(1 << b for b in dice.sample(range(64), dice.randint(1, 5))) for p in prints for _ in range(2)]
    near = {a: {b for b in prints if (a ^ b).bit_count() <= 2} for a in prints}
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    frame = spark.createDataFrame([(signed(p),) for p in set(prints)], "fp long").repartition(3)
    links = simhash.link_prints(frame, max_bits=2, blocks=1)
    got = {r.node: r.root for r in simhash.components(links).collect()}
    want = {}
    for start in prints:
        seen, todo = {start}, [start]
        while todo:
            more = near[todo.pop()] - seen
            seen |= more
            todo += more
        if len(seen) > 1:
            want[signed(start)] = min(map(signed, seen))
    assert got == want


def test_links_agree_with_the_number_of_bits(spark):
    frame = spark.createDataFrame([(0,), (3,), (7,)], "fp long")
    links = {(r.a, r.b) for r in simhash.link_prints(frame, max_bits=2, blocks=1).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).collect()}
    assert links <= {(3, 0), (7, 3)} and len(links) == 2
