import corpus_pipeline
from helpers import SF, table
from test_bpe import brute as tokens
from test_line_dedup import brute as line_brute
from test_quality import verdicts
from test_simhash import brute as components
from tokenizers import Tokenizer

from feria.llm import mixing
from feria.llm.queries import bpe_path


def test_stages_match_brute_force(spark, tmp_path):
    """Every stage on its predecessor's rows, against all-pairs versions."""
    docs = table(spark, "documents")
    columns, seen = docs.columns, {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(n)))
        after = spark.read.parquet(str(tmp_path / str(n)))
        assert n == len(corpus_pipeline.STAGES) - 1 or after.columns == columns
        seen[name] = ([r.asDict() for r in docs.collect()], [r.asDict() for r in after.collect()])
        docs = after

    before, after = seen["quality rules"]
    kept = {r["doc_id"] for r in after}
    assert {r["doc_id"] for r, k in zip(before, verdicts([(r["source"], r["text"]) for r in before])) if k} == kept
    assert {r["doc_id"]: r["text"] for r in before if r["doc_id"] in kept} == {r["doc_id"]: r["text"] for r in after}

    before, after = seen["line dedup"]
    gone = {i: set(places) for i, _, _, _, places in line_brute([(r["doc_id"], r["text"]) for r in before], 1, 16)}
    want = {r["doc_id"]: "\n".join(x for n, x in enumerate(r["text"].split("\n")) if n not in gone[r["doc_id"]]) for r in before}
    assert want == {r["doc_id"]: r["text"] for r in after} and all(r["n_chars"] == len(r["text"]) for r in after)

    before, after = seen["SimHash near-dedup"]
    assert {c for _, _, c in components([(r["doc_id"], r["text"]) for r in before])} == {r["doc_id"] for r in after}
    assert len(after) == len({r["doc_id"] for r in after})

    before, after = seen["mixing"]
    texts = {r["doc_id"]: r for r in before}
    counts: dict = {}
    for r in after:
        own = texts[r["doc_id"]]["text"]
        assert r["text"] == own or own.split()[: len(r["text"].split())] == r["text"].split()
        counts[r["source"]] = counts.get(r["source"], 0) + len(r["text"].split())
    spark_sizes = spark.createDataFrame([(r["source"], len(r["text"].split()), 1) for r in before], "source string, size long, docs long")
    for r in mixing.targets(spark_sizes).collect():
        assert abs(counts.get(r.source, 0) - r.target) <= 1

    before, after = seen["BPE encoding and decoding"]
    library = Tokenizer.from_file(bpe_path())
    library.no_truncation()
    library.no_padding()
    want = sorted((r["doc_id"], *tokens(library, r["text"])) for r in before)
    assert want == sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in after)


def test_run_is_the_stages_in_order(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "source", "ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert out.count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "SimHash near-dedup", "mixing", "BPE encoding and decoding"]
