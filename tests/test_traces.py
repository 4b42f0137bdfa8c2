"""Reasoning-trace removal against a plain-Python line machine (three range flags)."""

import random
import re

from conftest import one_col
from curata.functions.traces import strip_trace


def py_strip(text):
    a = b = c = False
    out = []
    for line in (text or "").split("\n"):
        if a:
            a = not re.search(r"</think>", line, re.I)
            continue
        if re.search(r"<think>", line, re.I):
            a = True
            continue
        if b:
            b = not re.search(r"done thinking\.", line, re.I)
            continue
        if re.search(r"think\.\.\.", line, re.I):
            b = True
            continue
        if c:
            c = not re.search(r"done thinking\.", line, re.I)
            continue
        if re.search(r"thinking\.\.\.", line, re.I):
            c = True
            continue
        if re.fullmatch(r"[ \t\r\f\v]*thinking[ \t\r\f\v]*", line, re.I) or re.fullmatch(r"[ \t\r\f\v]*", line):
            continue
        out.append(re.sub(r" {2,}", " ", re.sub(r"^[ \t\r\f\v]+|[ \t\r\f\v]+$", "", line)))
    return "\n".join(out)


CASES = [
    "<think>\nplan\n</think>\nAnswer  here ",
    "<think>x</think>\nstill inside\n</think>\nafter",
    "<THINK>\nnever closed\nmore",
    "Thinking...\nhmm\n...done thinking.\nResult",
    "think...\na\nthinking...\ndone thinking.\nb\ndone thinking.\nc",
    "<think>\nthink...\n</think>\nkept?\ndone thinking.\nz",
    "  Thinking  \n\n   \nfinal   text  ",
    "", None, "plain\n\n line  two ",
]


def test_trace_cases(spark):
    want = [py_strip(c) for c in CASES]
    assert one_col(spark, CASES, strip_trace) == want


def test_trace_random(spark):
    rnd = random.Random(11)
    pieces = ["<think>", "</think>", "think...", "Thinking...", "done thinking.", "thinking", "  ", "word",
              "a  b", "", "x<think>y", "DONE THINKING."]
    cases = ["\n".join(" ".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 3)))
                       for _ in range(rnd.randint(0, 8))) for _ in range(600)]
    want = [py_strip(c) for c in cases]
    assert one_col(spark, cases, strip_trace) == want


def test_trace_long_text(spark):
    import time
    body = "\n".join(f"line  {i}" for i in range(100000))
    text = "<think>\nplan\n</think>\n" + body + "\nThinking...\nx\ndone thinking.\nend"
    t0 = time.time()
    got = one_col(spark, [text], strip_trace)[0]
    assert got == py_strip(text)
    assert time.time() - t0 < 60
