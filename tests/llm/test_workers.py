"""Task functions run in a process that lacks the package."""

import subprocess
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark import cloudpickle

from lexmill.llm import boilerplate, encoding, lookalike, markup, packing, sentences, termcount, truncation

TEXT = "今天下雨。\n<b>The</b> lantern ρaper burned. Ã©tÃ© ロ音…"
BIGRAMS = encoding.Bigrams(np.array([1, 2]), np.array([5, 6]), np.ones(encoding.FIRSTS))
CLEAN = "今天下雨，明天放晴。"
COUNTED = encoding._of_buckets(next(encoding._count(iter([pd.DataFrame({"text": [CLEAN]})]))))
WRONG = CLEAN.encode().decode("gb18030", "ignore")
LINE = {
    "row_id": ["1"], "page": ["p1"], "line_no": [0], "k": [0], "again": [0], "textual": [False], "structural": [False], "lost": [False], "labelled": [False], "running": [False],
    "bare": ["首页 地图"], "head": [1], "tail": [2], "chars": [5], "linked": [0], "links": [0], "tags": [1], "elements": [""],
}
TASKS = {
    "p1": (lookalike._rewriting(lookalike.representatives({}), {}, lookalike.Frequencies()), {"row_id": ["1"], "text": [TEXT]}),
    "p1 counts": (lookalike._count(["é", "é"]), {"text": [TEXT]}),
    "p2": (termcount._accumulate, {"term_id": [5], "freq": [2], "in_record": [1]}),
    "p3": (markup._run(markup.model(), True), {"row_id": ["1"], "text": [TEXT]}),
    "p4": (boilerplate._judge(boilerplate.Forms(9, {1: (0.5, 1.0)}, {}, {"首页"})), LINE),
    "p5": (sentences._split({"en": sentences.Statistics()}), {"row_id": ["1"], "lang": ["en"], "text": [TEXT]}),
    "p6": (encoding._analyse(BIGRAMS), {"row_id": ["1"], "source": ["a"], "lost": [True], "text": [TEXT]}),
    "p6 counts": (encoding._count, {"text": [TEXT]}),
    "p6 spoiled": (encoding._count_spoiled(encoding._of_counts(COUNTED[: encoding.BUCKETS], COUNTED[encoding.BUCKETS :])), {"text": [WRONG]}),
    "p7": (packing._split(8, 8), {"doc_id": ["1"], "text": [TEXT], "prompt": [3]}),
    "p9": (truncation._of_texts(np.full(truncation.BITS // 8, 255, np.uint8)), {"text": [TEXT]}),
    "p9 ends": (truncation._of_ends, {"tail_id": [1], "tail": [TEXT]}),
}


@pytest.mark.parametrize("name", TASKS)
def test_task_needs_no_package(name, tmp_path):
    func, frame = TASKS[name]
    (tmp_path / "task").write_bytes(cloudpickle.dumps((func, pd.DataFrame(frame))))
    code = "import pickle, sys; f, pdf = pickle.load(open('task', 'rb')); rows = sum(len(x) for x in f(iter([pdf, pdf.head(0)]))); assert rows, rows; assert 'lexmill' not in sys.modules"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin"}, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
