"""Random fields: features, decoding against brute force, gradients against differences, training."""

import itertools

import numpy as np
import pandas as pd
import pytest

from lexmill.operators.crf import decode, features, files, model, train
from lexmill.sources import sinks

TEMPLATES = features.read_templates("# c\nU1:%x[-2,0]\nU2:%x[0,0]/%x[1,0]\n\nB\n")


def test_templates():
    assert features.expand(["a", "b"], 0, TEMPLATES) == ["U1:_B-2", "U2:a/b"]
    assert features.expand(["a", "b"], 1, TEMPLATES) == ["U1:_B-1", "U2:b/_B+1", "B"]
    with pytest.raises(ValueError):
        features.read_templates("X")


def _lattice(seed, n=5, y=3):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(n, y)), rng.normal(size=(n, y, y))


@pytest.mark.parametrize("seed", range(5))
def test_decoding_against_every_path(seed):
    emit, move = _lattice(seed)
    paths = sorted(((decode.path_score(emit, move, np.array(p)), p) for p in itertools.product(range(3), repeat=5)), reverse=True)
    path, score, _ = decode.viterbi(emit, move)
    assert tuple(path) == paths[0][1] and np.isclose(score, paths[0][0])
    best = decode.n_best(emit, move, 7)
    assert np.allclose([s for _, s in best], [s for s, _ in paths[:7]])
    alpha, beta, z = decode.forward_backward(emit, move)
    assert np.isclose(z, np.log(sum(np.exp(s) for s, _ in paths)))
    assert np.allclose(np.exp(alpha + beta - z).sum(1), 1)


def _ragged(seed, n=6):
    """Sentences end to end, of few scores so that many paths are equal: sizes, emissions, transitions of each place, and each sentence's own."""
    rng, y = np.random.default_rng(seed), 3
    sizes = rng.integers(1, 8, n)
    emit, move = rng.integers(-2, 3, (sizes.sum(), y)) / 2, rng.integers(-2, 3, (1 if seed % 2 else sizes.sum(), y, y)) / 2
    cuts = np.cumsum(sizes)[:-1]
    return sizes, emit, move, list(zip(np.split(emit, cuts), np.split(np.broadcast_to(move, (sizes.sum(), y, y)), cuts)))


def _stacked(sizes, emit, move):
    stack = decode.Stack(sizes)
    return stack, stack.stacked(emit), stack.stacked(move) if len(move) > 1 else move


@pytest.mark.parametrize("seed", range(6))
def test_stacked_marginals_are_those_of_each(seed):
    sizes, emit, move, each = _ragged(seed)
    stack = _stacked(sizes, emit, move)
    want = [decode.forward_backward(*x) for x in each]
    alpha, beta, p = decode._posteriors(*stack)
    assert np.allclose(alpha, np.concatenate([a for a, _, _ in want])) and np.allclose(beta, np.concatenate([b for _, b, _ in want]))
    assert np.allclose(p, np.concatenate([np.exp(a + b - z) for a, b, z in want]))
    assert np.allclose(decode.forward_many(*stack, np.max)[stack[0].rows], np.concatenate([decode.viterbi(*x)[2] for x in each]))


def test_expected_counts_sum_the_marginals(spark):
    ids, size = model.number_features(["U1:a", "U1:_B-2", "U2:a/b", "B"], 2)
    m = model.Model(["B", "S"], TEMPLATES, ids, np.random.default_rng(2).normal(size=size))
    rows = spark.createDataFrame([(k, 0, 0, list(t)) for k, t in enumerate(("ab", "", "abba", "b"))] + [(None, 1, 2, ["a"])], "key long, line_no int, sent_no int, tokens array<string>")
    each, sums = decode.tag_marginals(rows, m).collect(), {}
    for r in each:
        n, total = sums.get((r["token"], r["tag"]), (0, 0.0))
        sums[r["token"], r["tag"]] = n + 1, total + r["prob"]
    assert len(each) == 16 and sorted({str(r["key"]) for r in each}) == ["0", "2", "3", "None"]
    got = decode.expected_counts(rows, m).collect()
    assert {(r["token"], r["tag"]): r["n"] for r in got} == {k: n for k, (n, _) in sums.items()}
    assert all(np.isclose(r["expected"], sums[r["token"], r["tag"]][1]) for r in got)

@pytest.mark.parametrize("n", [2, 3, 7])
@pytest.mark.parametrize("seed", range(6))
def test_stacked_paths_are_those_of_each_even_among_equals(seed, n):
    sizes, emit, move, each = _ragged(seed)
    stack = _stacked(sizes, emit, move)
    paths, scores = decode.n_best_many(*stack, n)
    paths = np.split(paths[stack[0].rows], np.cumsum(sizes)[:-1])
    for k, x in enumerate(each):
        want = decode.n_best(*x, n)
        assert np.isfinite(scores[k]).sum() == len(want) and np.allclose(scores[k, : len(want)], [s for _, s in want])
        assert [tuple(p) for p in paths[k].T[: len(want)]] == [tuple(p) for p, _ in want]


def test_paths_of_a_table(spark):
    ids, size = model.number_features(["U1:a", "U1:_B-2", "U2:a/b", "B"], 2)
    m = model.Model(["B", "E"], TEMPLATES, ids, np.random.default_rng(2).normal(size=size))
    texts = {0: ["a", "bc", "龙", "a"], 1: [], 3: ["b"], None: ["a", "b"]}
    rows = spark.createDataFrame([(k, 1, 2, t) for k, t in texts.items()], "key long, line_no int, sent_no int, tokens array<string>")
    for drop_last in (True, False):
        got = decode.tag(rows, m, nbest=3, drop_last=drop_last).collect()
        assert sorted((str(r["key"]), r["rank"]) for r in got) == [("0", 0), ("0", 1), ("0", 2), ("3", 0), ("3", 1), ("None", 0), ("None", 1), ("None", 2)]
        for r in got:
            emit, move = m.scores(texts[r["key"]])
            path, score = decode.n_best(emit, move, 3)[r["rank"]]
            assert r["tags"] == [m.tags[t] for t in path] and r["words"] == decode.words_of(r["tokens"], r["tags"], drop_last)
            assert np.isclose(r["score"], score) and np.isclose(r["prob"], np.exp(score - decode.forward_backward(emit, move)[2])) and r["tokens"] == texts[r["key"]]


def test_stacked_sentences_decode_as_single_ones():
    rng = np.random.default_rng(4)
    ids, size = model.number_features(["U1:a", "U1:_B-2", "U2:a/b", "B"], 3)
    m = model.Model(["x", "y", "z"], TEMPLATES, ids, rng.normal(size=size))
    sentences = [list(s) for s in ("abab", "bbaa", "a", "ab", "aaaa", "abcabc")]
    for templates in (TEMPLATES, [*TEMPLATES, features.Template("U3:%x[-2,0]|%x[2,0]"), features.Template("B2:%x[-1,0]%x[0,0]")]):
        feats = sorted({f for t in sentences for i in range(len(t)) for f in features.expand(t, i, templates)})[::2] + ["B"]
        ids, size = model.number_features(sorted(set(feats)), 3)
        m = model.Model(["x", "y", "z"], templates, ids, rng.normal(size=size), 0.5)
        emit, move = m.scores_of_batch(sentences)
        want = [m.scores(t) for t in sentences]
        assert np.allclose(emit, np.concatenate([e for e, _ in want]))
        inner = np.concatenate([np.arange(len(t)) > 0 for t in sentences])
        assert np.allclose(np.broadcast_to(move, (len(emit), 3, 3))[inner], np.concatenate([v for _, v in want])[inner])
    for (path, score), tokens in zip(decode._best_paths(m, sentences), sentences):
        want, best, _ = decode.viterbi(*m.scores(tokens))
        assert (path == want).all() and np.isclose(score, best)


def test_gradient_against_differences():
    tokens, gold, y = list("abca"), np.array([0, 1, 2, 0]), 3
    ids, size = model.number_features(sorted({f for i in range(4) for f in features.expand(tokens, i, TEMPLATES)}), y)
    m = model.Model(["x", "y", "z"], TEMPLATES, ids, np.zeros(size))
    uni, bi = train._prepare(m, tokens)
    w = np.random.default_rng(0).normal(size=size)
    grad = np.zeros(size)
    train.sentence_gradient(w, uni, bi, gold, y, grad)
    for k in range(size):
        step = np.zeros(size)
        step[k] = 1e-5
        up, down = (train.sentence_gradient(w + s, uni, bi, gold, y, np.zeros(size))[0] for s in (step, -step))
        assert np.isclose(grad[k], (up - down) / 2e-5, atol=1e-5)


def test_batch_gradient_is_the_sum():
    rng, y = np.random.default_rng(1), 3
    sentences = [list(s) for s in ("abca", "b", "cc", "acbb", "ab")]
    ids, size = model.number_features(sorted({f for t in sentences for i in range(len(t)) for f in features.expand(t, i, TEMPLATES)}), y)
    m = model.Model(["x", "y", "z"], TEMPLATES, ids, rng.normal(size=size))
    tags = [[m.tags[k] for k in rng.integers(0, y, len(t))] for t in sentences]
    pdf = next(train._number(m)(iter([pd.DataFrame({"tokens": sentences, "tags": tags})])))
    want, got, loss, wrong = np.zeros(size), np.zeros(size), 0.0, 0
    for tokens, gold in zip(sentences, tags):
        part, bad = train.sentence_gradient(m.weights, *train._prepare(m, tokens), np.array([m.tags.index(t) for t in gold]), y, want)
        loss, wrong = loss + part, wrong + bad
    result = train.batch_gradient(m.weights, pdf, y, got)
    assert np.allclose(got, want) and np.isclose(result[0], loss) and result[1] == wrong and result[3] == sum(map(len, sentences))


def test_words_and_text_form():
    assert decode.words_of(list("abcd。"), list("BESSS")) == ["ab", "c", "d"]
    assert decode.words_of(list("ab"), ["B", "E"], drop_last=False) == ["ab"]
    ids, size = model.number_features(["U1:a", "B"], 2)
    m = model.Model(["B", "S"], TEMPLATES, ids, np.arange(size) / 3)
    back = model.from_text(model.to_text(m))
    assert back.ids == m.ids and back.tags == m.tags and np.allclose(back.weights, m.weights)


def test_model_files(tmp_path):
    rng = np.random.default_rng(6)
    names = sorted({f"U0{rng.integers(3)}:{''.join(rng.choice(list('的了甲乙ab'), rng.integers(1, 4)))}" for _ in range(900)} | {"B", "U00:", "U0"})
    ids, size = model.number_features(names, 3)
    m = model.Model(["B", "M", "S"], TEMPLATES, ids, rng.normal(size=size).astype(np.float32).astype(float), 1.5)
    files.save(m, str(tmp_path / "m"), text=True)
    for path in ("m", "m.txt"):
        back = files.load(str(tmp_path / path))
        assert back.ids == m.ids and back.tags == m.tags and np.allclose(back.weights, m.weights) and back.cost_factor == 1.5
        assert sorted(t.text for t in back.templates) == sorted(t.text for t in m.templates)
    data = files.to_binary(m)
    for broken in (data[:-4], b"\xff" + data[1:4].replace(b"\0", b"\1") + data[4:]):
        with pytest.raises(ValueError):
            files.from_binary(broken)
    with pytest.raises(ValueError):
        files.load(str(tmp_path / "m"), cost_factor=0.0)


def test_results_and_transitions(spark):
    ids, size = model.number_features(["U1:a", "U1:_B-2", "U2:a/b", "B"], 2)
    m = model.Model(["B", "S"], TEMPLATES, ids, np.random.default_rng(2).normal(size=size))
    rows = spark.createDataFrame([(1, 0, 0, list("ab"), ["B", "X"]), (2, 0, 0, [], [])], "key long, line_no int, sent_no int, tokens array<string>, tags array<string>")
    got = decode.results(rows, m).orderBy("i").collect()
    emit, move = m.scores(list("ab"))
    path, z = decode.viterbi(emit, move)[0], decode.forward_backward(emit, move)[2]
    assert [r["tag_id"] for r in got] == path.tolist() and [r["gold_id"] for r in got] == [0, None] and [r["tag"] for r in got] == [m.tags[t] for t in path]
    first, second = decode.transitions(rows, m).orderBy("i").collect()
    assert np.isclose(first["z"], z) and first["transition_costs"] == [] and np.allclose(second["transition_costs"], -move[1])
    assert first["emission_vector"] == [ids["U1:_B-2"], ids["U2:a/b"]] and second["transition_vector"] == [ids["B"]]
    text = sinks.tagged_text(decode.results(rows, m)).first()["text"]
    assert text == f"a\t{got[0]['tag']}\nb\t{got[1]['tag']}\n\n"
    assert files.shape(spark, m).first().asDict()["maxid"] == size


def test_wolfe_steps():
    for f, df in [(lambda x: (x - 3) ** 2, lambda x: 2 * (x - 3)), (lambda x: -x / (x * x + 2), lambda x: (x * x - 2) / (x * x + 2) ** 2), (lambda x: (x + 0.004) ** 5 - 2 * (x + 0.004) ** 4, lambda x: 5 * (x + 0.004) ** 4 - 8 * (x + 0.004) ** 3)]:
        for first in (1e-3, 1.0, 10.0):
            step, value, slope, _ = train.wolfe_step(lambda t: (f(t), df(t), t), f(0), df(0), first, tries=40)
            assert value <= f(0) + 1e-4 * step * df(0) and abs(slope) <= 0.9 * abs(df(0))


def test_mira_bounds_a_sentence():
    uni, bi, gold = [[0], [2]], [[], []], np.array([0, 1])
    w = np.zeros(4)
    w[1] = 50.0
    wrong, step, violated = train.mira_step(w, uni, bi, gold, 2, 0.25)
    assert wrong and step == 0.25 and violated == 0.0
    assert train.mira_step(np.zeros(4), [[0], [2]], bi, gold, 2, 9.0)[2] > 0


@pytest.mark.parametrize("room", [0.2, 9.0])
@pytest.mark.parametrize("templates", [TEMPLATES, [*TEMPLATES, features.Template("B2:%x[-1,0]%x[0,0]")]])
def test_mira_rows_take_the_steps_of_each_sentence(templates, room):
    rng, y = np.random.default_rng(3), 3
    sentences = [list(rng.choice(list("abcd"), n)) for n in rng.integers(1, 9, 60)]
    ids, size = model.number_features(sorted({f for t in sentences for i in range(len(t)) for f in features.expand(t, i, templates)})[::2] + ["B0"], y)
    m = model.Model(["x", "y", "z"], templates, ids, rng.normal(size=size))
    tags = [[m.tags["abcd".index(c) % y] for c in t] for t in sentences]
    row = next(train._number(m)(iter([pd.DataFrame({"tokens": sentences, "tags": tags})]))).iloc[0]
    w, wide = m.weights.copy(), train._wide(m.weights, y)
    used, right, got_used, got_right = np.zeros(60), np.zeros(60, int), np.zeros(60), np.zeros(60, int)
    for _ in range(5):
        wrong, wrong_sentences, violations = 0, 0, 0.0
        for k, (tokens, gold) in enumerate(zip(sentences, tags)):
            if right[k] < 2:
                bad, step, violated = train.mira_step(w, *train._prepare(m, tokens), np.array([m.tags.index(t) for t in gold]), y, room - used[k])
                right[k], used[k] = (right[k] + 1 if not bad else 0), used[k] + step
                wrong, wrong_sentences, violations = wrong + bad, wrong_sentences + (bad > 0), violations + violated
        counts = train._mira_row(wide, row, y, got_used, got_right, room, 2)
        assert np.allclose(counts, [wrong, wrong_sentences, sum(map(len, sentences)), 60, violations])
        assert (right == got_right).all() and np.allclose(used, got_used) and np.allclose(w, wide[:size]) and not wide[size:].any()


@pytest.mark.parametrize("algorithm", ["crf-l2", "crf-l1", "mira"])
def test_training_learns(spark, algorithm):
    docs = spark.createDataFrame([(k, "我/爱/北京\n北京/我/爱/天安门\n") for k in range(3)] + [(9, None), (10, "无")], "doc_id long, text string")
    m, course = train.train(features.gold(docs).select("tokens", "tags"), algorithm, rounds=25)
    assert course[-1]["token_error"] < course[0]["token_error"] or course[-1]["token_error"] == 0
    rows = spark.createDataFrame([(1, 0, 0, list("我爱天安门。")), (2, 0, 0, [])], "key long, line_no int, sent_no int, tokens array<string>")
    assert [list(r["words"]) for r in decode.tag(rows, m).collect()] == [["我", "爱", "天安门"]]
    if algorithm == "crf-l1":
        assert (m.weights == 0).any()


def test_mira_goes_on_with_its_sentences_after_they_are_written(spark):
    docs = spark.createDataFrame([(1, "我/爱\n我爱/\n")], "doc_id long, text string")
    m, course = train.train(features.gold(docs).select("tokens", "tags"), "mira", c=1e9, rounds=10)
    assert [c["iteration"] for c in course] == list(range(10)) and all(c["sentence_error"] > 0 for c in course)
    rows = spark.createDataFrame([(1, 0, 0, list("我爱。"))], "key long, line_no int, sent_no int, tokens array<string>")
    assert "".join(decode.tag(rows, m, columns=["words"]).first()["words"]) == "我爱"


def test_training_queries_run_to_their_own_end(spark):
    from lexmill import queries

    course = queries.queries()["crf_train_mira"](spark, "/root/testdata/sf0.001").orderBy("iteration").collect()
    assert len(course) < 100 and course[-1]["sentence_error"] == 0 and course[0]["sentence_error"] > 0
