"""Every registered query against SQL or a brute-force version."""

import math
from collections import Counter, defaultdict

import brute
import public_tokenizers
import pytest
import sentencepiece
from oracle import expected, rows_of

import corpus_pipeline
from meterspark.llm import catalog, mixing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()


def result(spark, name, sf=SF):
    return catalog.queries()[name](spark, sf).collect()


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_agrees_with_sql(spark, name):
    df = catalog.queries()[name](spark, SF)
    columns, want = expected(SF, catalog.oracle_sql()[name])
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, want)


def test_op1(spark):
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns[r.conv_id].append((r.role, r.text or ""))
    turns[-7] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r for r in result(spark, "op1_chat_formatting")}
    assert set(got) == set(turns)
    for i, own in turns.items():
        learnt = "".join(t for role, t in own if role == "assistant")
        r = got[i]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (
            len(own), brute.sha("".join(f"{a}\n{b}\n" for a, b in own)), len(learnt), brute.sha(learnt))
        assert r.formatted_chars > sum(len(t) for _, t in own)


def test_op3(spark, docs):
    want = {(i, n, k, brute.sha(t)) for i, n, k, t in
            brute.without_repeats([(d.doc_id, d.text) for d in docs], 35)}
    assert {tuple(r) for r in result(spark, "op3_substring_dedup")} == want


def test_op4(spark, docs):
    split = {d.doc_id: [*brute.words(d.text, fold=True), "\0end"] for d in docs}
    seen = Counter(w for i, own in split.items() if brute.crc(i) % 7 != 2 for w in own)
    n, v = sum(seen.values()), len(seen)
    got = {r.doc_id: r for r in result(spark, "op4_lm_scoring")}
    assert set(got) == set(split)
    for i, own in split.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            brute.crc(i) % 7 == 2, len(own), sum(seen[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in own))
    held = [r for r in got.values() if r.held_out and r.n_bytes > 200]
    assert all(r.score < 0 for r in got.values())
    # Better than coding letters by their frequencies, on texts that were not learnt.
    assert sum(r.score for r in held) * -math.log2(10) / sum(r.n_bytes for r in held) < 3.2


def test_op5(spark, docs):
    got = {r.doc_id: r for r in result(spark, "op5_secret_scan")}
    assert set(got) == {d.doc_id for d in docs}
    found = 0
    for d in docs:
        base = brute.base_spans(d.text)
        found += len(base)
        listed = [f"{kind}:{a}:{b}" for a, _, kind, b in base]
        r = got[d.doc_id]
        assert r.base_sha256 == brute.sha(",".join(listed))
        assert [s for s in r.spans.split(",") if s and not s.startswith("token")] == listed
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(
            sum(k == kind for _, _, k, _ in base) for kind in ("assign", "access", "hex"))
    assert found


def test_op6(spark, docs):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = set()
    for d in docs:
        ids = model.encode(d.text or "")
        want.add((d.doc_id, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(model.decode(ids))))
    assert {tuple(r) for r in result(spark, "op6_sentencepiece")} == want


def test_op7(spark, docs):
    want = brute.near_groups([(d.doc_id, d.text) for d in docs], 4, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in result(spark, "op7_ngram_jaccard")} == want


def test_op8_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = result(spark, "op8_language_id", sf)
    assert {r.doc_id for r in got} == set(lang)
    assert all(r.held_out == (brute.crc(r.doc_id) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r.lang_pred == lang[r.doc_id] for r in got if r.held_out]
    assert sum(held) / len(held) > 0.97


def test_op9(spark, docs):
    size = Counter()
    for d in docs:
        size[d.source] += len(brute.words(d.text))
    got = result(spark, "op9_mixing")
    assert {r.doc_id for r in got} == {d.doc_id for d in docs}  # nothing is lost
    weight = {r.source: r["weight"] for r in got}
    assert sum(weight.values()) == pytest.approx(1)
    made = Counter()
    for r in got:
        made[r.source] += r.n_tokens
    passes = {s: made[s] / size[s] for s in size}
    low = min(weight[s] / size[s] for s in size)
    for s in size:  # what a source gets: its weight, and at most the document that reaches it
        longest = max(len(brute.words(d.text)) for d in docs if d.source == s)
        assert -1 <= made[s] - weight[s] / low <= longest
    assert max(weight[s] / size[s] for s in size) / low <= 2.0 + 1e-6 and max(passes.values()) < 3
    assert len({(r.doc_id, r["pass"]) for r in got}) == len(got)


def test_op10(spark, docs):
    got = {r.doc_id: r for r in result(spark, "op10_fingerprints")}
    by_text = {}
    for d, after in zip(docs, [*docs[1:], docs[0]]):
        text, n = d.text or "", len(d.text or "")
        edited = text[:n - n // 2] + (after.text or "")[:n // 2]
        r = got[d.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, brute.sha(edited))
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        assert by_text.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.near_next == 1.0) == (text == (after.text or ""))
    assert len(set(by_text.values())) == len(by_text)
    assert sum(r.near_edited for r in got.values()) > sum(r.near_next for r in got.values()) + 20


def test_pipeline_stage_by_stage(spark, tmp_path):
    """Each stage against a plain version of its decision, on what the one before it kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        before, rows = docs.collect(), after.collect()
        if name != "sentencepiece":
            assert after.columns == docs.columns
        if name == "language_id":
            assert {r.doc_id for r in before} - {r.doc_id for r in rows} <= {
                r.doc_id for r in before if len(brute.words(r.text)) < 5}
        elif name == "ngram_jaccard":
            groups = brute.near_groups([(r.doc_id, r.text) for r in before], 5, 80)
            assert sorted(r.doc_id for r in rows) == sorted({low for _, low in groups.values()})
        elif name == "secret_scan":
            text = {r.doc_id: r.text for r in rows}
            assert set(text) == {r.doc_id for r in before}
            assert all(r.n_chars == len(r.text) for r in rows)
            for r in before:
                assert ("[secret]" in text[r.doc_id]) or text[r.doc_id] == r.text
        elif name == "mixing":
            assert {tuple(r) for r in rows} == {tuple(r) for r in before}
            assert max(Counter(r.doc_id for r in rows).values()) <= 2
        else:
            want = Counter((r.doc_id, tuple(model.encode(r.text))) for r in before)
            assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == want
            assert all(r.round_trip for r in rows)
        docs = after


def test_one_row_of_each_group_stays(spark):
    """Repeated rows, rows without id, and one id for several texts."""
    def prose(name):
        return " ".join(f"{name}{i}" for i in range(40))

    rows = [(1, prose("a"), "en", "s"), (1, prose("a"), "en", "s"), (1, prose("a"), "en", "r"),
            (2, prose("a") + " more", "en", "s"), (1, prose("a") + " and", "en", "a"), (2, prose("b"), "en", "s"), (3, prose("c"), "en", "s"),
            (3, prose("d"), "en", "s"), (None, prose("e"), "en", "s"), (None, prose("e"), "en", "t"),
            (None, prose("f"), "en", "s"), (None, prose("c"), "en", "s"), (4, prose("d"), "en", "s"),
            (5, None, "en", "s"), (6, None, "en", "s"), (6, None, "en", "s"), (7, "", "en", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)
    after = corpus_pipeline.one_of_each(spark, docs, SF)
    assert after.columns == docs.columns
    want = [(1, prose("a"), "r"), (2, prose("b"), "s"), (3, prose("c"), "s"), (3, prose("d"), "s"),
            (None, prose("e"), "s"), (None, prose("f"), "s"), (5, None, "s"), (6, None, "s"), (7, "", "s")]
    assert sorted(((r.doc_id, r.text, r.source) for r in after.collect()), key=str) == sorted(want, key=str)


def test_all_are_registered():
    import __spark_entry__ as entries
    names = [n for n in entries.queries() if n.startswith("op") or n == "pipeline"]
    assert len(names) == 14


def test_exponent_meets_an_entropy(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 100), ("c", 10)], "_mix_source string, _mix_tokens long")
    for target in (0.5, 0.8, 0.95):
        w = [r["weight"] for r in mixing.weights(sizes, mixing.Target(entropy=target)).collect()]
        assert -sum(x * math.log(x) for x in w) / math.log(3) == pytest.approx(target, abs=1e-6)
