import re
from collections import Counter, defaultdict

import pytest

from moodline.llm import line_quality as lq

SPACE = r"[^\x20\x09-\x0D]+"


def _form(line):
    folded = line.translate({**{c: c + 32 for c in range(65, 91)}, **dict.fromkeys(range(48, 58), 48)})
    return " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded))


def _brute(rows, least, share, left):
    """(id, host, text) rows -> verdict rows and cleaned texts, written out."""
    rows = [(i, h, t or "") for i, h, t in rows]
    held, hosts = defaultdict(set), defaultdict(set)
    for _, h, t in rows:
        hosts[h].add(t)
        for line in t.split("\n"):
            if _form(line):
                held[h, _form(line)].add(t)
    over = {k for k, v in held.items() if len(v) >= least and len(v) > share * len(hosts[k[0]])}
    out, texts = [], []
    for i, h, t in rows:
        w = re.findall(SPACE, t)
        windows = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
        covered = {p for k in range(len(w) - 7) if windows[tuple(w[k:k + 8])] > 1 for p in range(k, k + 8)}
        lines = [x for x in t.split("\n") if re.search(SPACE, x)]
        gone = [x for x in t.split("\n") if (h, _form(x)) in over]
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        removed = sum(len(re.findall(SPACE, x)) for x in gone)
        kept = not failed and len(w) - removed >= left * len(w)
        out.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered),
                    failed, len({_form(x) for x in gone}), removed, kept))
        if kept:
            texts.append("".join(x for x in re.findall(r"[^\n]*\n|[^\n]+$", t) if (h, _form(x.rstrip("\n"))) not in over))
    return out, texts


def _same(docs_of, rows, least=3, share=0.0, left=0.3):
    docs = docs_of([(i, t, "en", h) for i, h, t in rows])
    want, texts = _brute(rows, least, share, left)
    got = lq.verdicts(docs, least=least, share=share, left=left)
    columns = ["doc_id", *lq.MEASURES, "base_failed", "n_removed_lines", "n_removed_words", "kept"]
    assert sorted(map(repr, (tuple(r) for r in got.select(columns).collect()))) == sorted(map(repr, want))
    clean = lq.cleaned(docs, least=least, share=share, left=left)
    assert clean.columns == docs.columns
    assert sorted(r["text"] for r in clean.select("text").collect()) == sorted(texts)


BODY = " ".join(f"own{k}" for k in range(30))


def test_lines_of_a_host(docs_of):
    rows = [(k, "a" if k < 8 else "b", f"Shared LINE {k % 3}, here\n{BODY} x{k}\n\n  shared line 7 here \n") for k in range(10)]
    rows += [(20, "a", f"shared line 0 here\n{BODY}"), (21, None, "shared line 1 here"), (21, None, f"shared line 1 here\n{BODY}")]
    _same(docs_of, rows)
    _same(docs_of, rows, share=0.9)


def test_copies_are_one_document(docs_of):
    """Fifty copies of one text make no line frequent; near copies of it do, and are depleted."""
    copy = "\n".join(f"line {chr(97 + k)} of the copied text stands here" for k in range(6))
    rows = [(k, "a", copy) for k in range(50)] + [(99, "b", copy + f"\n{BODY}")]
    _same(docs_of, rows)
    near = rows + [(100 + k, "a", copy + f"\n{BODY} variant {chr(97 + k)}") for k in range(5)]
    _same(docs_of, near, left=0.6)


@pytest.mark.parametrize("text", [
    "", "a", "\n\n", "a b c d e f g h " * 9, "x " * 200, "a\r\nb\r\na\r\n" * 3, "é ü # * $%&|<> \x0b \x0c \x85 z", "9 9\n8 8\n7 7",
    "a b c d e f g h i a b c d e f g h j", "-- --\n-- --\n" * 5 + BODY, "w " * 400_000 + "\n" + BODY, "﻿ no\x00break"])
def test_measures_of_odd_texts(docs_of, text):
    _same(docs_of, [(1, "a", text), (1, "a", text), (2, "a", None), (None, None, text + "!")], least=2)


def test_empty_table(docs_of):
    docs = docs_of([(1, "a")]).where("false")
    assert lq.verdicts(docs).count() == 0 and lq.cleaned(docs).count() == 0
