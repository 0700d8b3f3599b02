"""The pipeline against a brute-force version of its stages, on the small tables."""

import zlib
from collections import Counter

import numpy as np
import pytest
from llm.test_forest import plain as near_duplicates
from llm.test_lines import plain as shared_lines
from tokenizers import Tokenizer

import corpus_pipeline
from tenura.llm import toxicity
from tenura.llm.queries import table, tokenizer_path


@pytest.fixture(scope="module")
def documents(spark, data_dir):
    return [(r.doc_id, r.text) for r in table(spark, data_dir, "documents").collect()]


def stages():
    return dict(corpus_pipeline.STAGES)


def test_stages_are_those_of_the_contract():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "jaccard_join", "packing"]


def test_run_like_brute_force(spark, data_dir, documents):
    docs = table(spark, data_dir, "documents")
    model = toxicity.train(docs, table(spark, data_dir, "labels"))
    cache = toxicity._WordWeights(model.weights)
    kept = [(d, t) for d, t in documents if model.score(t or "", cache) < 0.5]
    assert 0.5 * len(documents) < len(kept) < len(documents)
    kept = [(d, t) for d, _, _, t in shared_lines(kept)]
    stays = {d for d, *_, c in near_duplicates(kept) if d == c}
    kept = [(d, t) for d, t in kept if d in stays]
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = Counter()
    for d, t in kept:
        ids = library.encode(t, add_special_tokens=False).ids + [1]
        for s in range(0, len(ids), 2048):
            want[d, s, zlib.crc32(np.asarray(ids[s:s + 2048], "<u4").tobytes()), len(ids)] += 1
    out = corpus_pipeline.run(spark, data_dir).collect()
    assert Counter((r.doc_id, r.start, r.ids_crc32, r.doc_tokens) for r in out) == want


@pytest.mark.parametrize("stage", ["toxicity", "line_dedup", "jaccard_join"])
def test_stages_return_the_columns_of_documents(spark, data_dir, docs_of, stage):
    rows = [(None, "a text of no id"), (1, None), (2, ""), (2, ""), (3, "x y z " * 3), (4, "x y z " * 3)]
    docs = docs_of(rows, {"row": "q", "kept": "q", "n": "q", "line_dedup": "q"})
    out = stages()[stage](spark, docs, data_dir)
    assert out.dtypes == docs.dtypes
    kept = Counter((r.doc_id, r.text) for r in out.collect())
    assert kept == Counter(rows if stage != "jaccard_join" else [r for r in rows if r[0] != 4])
    assert stages()[stage](spark, docs_of([]), data_dir).collect() == []


def test_n_chars_follows_a_changed_text(spark, data_dir, docs_of):
    line = "a line that is long enough to be counted as shared"
    out = corpus_pipeline.line_dedup(spark, docs_of([(i, f"own {i}\n{line}") for i in range(6)]), data_dir).collect()
    assert sorted((r.doc_id, r.n_chars) for r in out) == [*((i, 5) for i in range(5)), (5, 6 + len(line))]
