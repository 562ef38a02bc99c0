"""The pipeline's stages, each against a plain restatement on its own input."""

import corpus_pipeline
import public_tokenizers
import pytest
import sentencepiece
from brute import WORD, components, greedy_tiles, repeated, tokens

from adgrove.llm import toxicity
from adgrove.operators.scratch import Scratch

SF = "/root/testdata/sf0.001"
BENCHMARK = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (2, None), (3, "one two three four five six seven")]
PASSAGE = " ".join(f"p{i}" for i in range(70))
OWN = [" ".join(f"{c}{i}" for i in range(60)) for c in "ab"]
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, row int"


def documents():
    rows = []
    for i in range(300):
        bad = i % 5 == 0
        words = [f"w{(i * 7919 + k * k * 31) % 997}" for k in range(12 + i % 40)]
        if bad:
            words[3:3] = ["wretchery", "wretched"]
        rows.append((i, " ".join(words)))
    near = rows[7][1].split()
    rows += [(400 + k, " ".join([*near[:-1], f"z{k}"] if k else near)) for k in range(4)]
    rows += [(500, "\n".join([OWN[0], PASSAGE, "tail of it"])), (501, OWN[1] + " " + PASSAGE), (502, PASSAGE)]
    rows += [(600, "so they said " + BENCHMARK[0][1].upper()), (601, "zeta eta theta iota kappa then alpha beta gamma delta epsilon")]
    rows += [(700, None), (701, ""), (702, "  "), (703, "long " * 30_000), (None, "no id here"), (704, "twice"), (704, "twice")]
    return [(d, t, "en" if d and d % 2 else None, "s", len(t or ""), "clash", 1) for d, t in rows]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output rows of every stage."""
    folder = tmp_path_factory.mktemp("sf")
    docs = documents()
    spark.createDataFrame(docs, COLUMNS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)], "doc_id bigint, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    spark.createDataFrame(BENCHMARK, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    scratch, now, out = Scratch(spark), spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        made, _ = scratch.cut(stage(spark, now, str(folder)))
        out.append(([tuple(r) for r in now.collect()], [tuple(r) for r in made.collect()], now.columns, made.columns))
        now = made
    return out


def same(a, b):
    return sorted(a, key=str) == sorted(b, key=str)


def test_five_stages_keep_the_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near duplicates", "repeated passages", "benchmark passages",
                                                      "tokens"]
    assert corpus_pipeline.ORACLE_SQL is None
    for _, _, before, after in stages[:-1]:
        assert after == before


def test_toxic_documents_go_and_clean_ones_stay(stages):
    before, after, _, _ = stages[0]
    left = {r[0] for r in after}
    assert not [i for i in range(0, 300, 5) if i in left]
    clean = [r for r in before if r[0] is None or r[0] >= 300 or r[0] % 5]
    assert same(after, clean)


def test_one_document_of_each_group_stays(stages):
    before, after, _, _ = stages[1]
    found = components(list({r[0]: r[1] for r in before if r[0] is not None}.items()), 5)
    assert same(after, {r for r in before if r[0] is None or found[r[0]][2]})
    assert len(before) - len(after) >= 5


def test_repeated_passages_are_cut(stages):
    before, after, _, _ = stages[2]
    want = repeated([r[:2] for r in before if r[0] is not None])
    got = {r[0]: r for r in after}
    for r in before:
        n, gone, _ = want[r[0]] if r[0] is not None else (0, 0, "")
        if gone and gone == n:
            assert r[0] not in got
        elif gone:
            words = WORD.findall(got[r[0]][1])
            assert len(words) == n - gone and got[r[0]][4] == len(got[r[0]][1])
        else:
            assert got[r[0]] == r
    assert got[501][1] == OWN[1] and 502 not in got


def test_benchmark_documents_go(stages):
    before, after, _, _ = stages[3]

    def contaminated(text):
        a = tokens(text)
        return any(2 * greedy_tiles(a[:200], tokens(item), min(5, len(tokens(item)))) >= len(tokens(item))
                   for _, item in BENCHMARK if item)

    assert same(after, [r for r in before if not contaminated(r[1])])
    assert not {600, 601} & {r[0] for r in after}


def test_tokens_are_the_librarys(stages):
    before, after, _, columns = stages[4]
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert columns == ["doc_id", "n_tokens", "ids"]
    want = [(r[0], model.encode(r[1] or "")) for r in before]
    assert same([(d, list(ids)) for d, _, ids in after], want) and all(n == len(ids) for _, n, ids in after)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
