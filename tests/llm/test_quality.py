import random
from collections import Counter

import pytest

from sessionrate.llm import quality as Q

from .conftest import edge_rows, prose


def brute_repeats(words):
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    return len({i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)})


@pytest.mark.parametrize("seed", range(8))
def test_repeated_words_against_plain_code(seed):
    rng = random.Random(seed)
    words = [rng.choice([b"a", b"b", b"c"][:1 + seed % 3]) for _ in range(rng.randint(0, 60))]
    assert Q.repeat_words(words) == brute_repeats(words)
    if len(words) >= 8:
        assert Q._repeat_words_long(words, 8) == brute_repeats(words)


def test_base_counts():
    row, _ = Q.judge("One two. \t three\x0b#4 é b\nOne\n\nOne\n|<>| $5%")
    assert row["n_words"] == 9 and row["word_chars"] == len("Onetwo.three#4é bOneOne|<>|$5%")
    assert row["n_symbols"] == 1 + 4 + 2 and row["n_dup_lines"] == 1 and row["base_failed"] and not row["kept"]


@pytest.mark.parametrize("line,fault", [
    ("Home | News | Sport | Contact", "nav"),
    ("some### words*** of&&& noise%%% here.", "symbols"),
    ("BUY THIS NOW AND SAVE!", "caps"),
    ("a title without an end", "punct"),
    ("Please accept cookies to go on.", "boilerplate"),
    ("go go go go go go now.", "repeated"),
    ("An ordinary sentence, as they come.", None),
    ('He said: "Come in."', None),
    ("Er kam; sie ging…", None),
])
def test_line_rules(line, fault):
    raw = line.encode()
    assert Q.line_fault(raw, raw.split(), any(p in raw.lower() for p in Q.BOILERPLATE)) == fault


def test_failing_lines_go_and_the_rest_stays():
    good = prose(1, 64)
    row, text = Q.judge(good + "\nHome | News | Sport\n\n" + good.split("\n")[0])
    assert row["kept"] and text == good + "\n" and row["lines_nav"] == 1 and row["lines_repeated"] == 1


def test_documents_that_lose_too_much_are_rejected():
    noise = "\n".join(" ".join(f"w{i}{j}***" for j in range(8)) for i in range(8))
    assert not Q.judge(prose(1, 64) + "\n" + noise)[0]["kept"]
    assert Q.judge(prose(1, 160) + "\n" + noise)[0]["kept"]


def test_clean_prose_is_left_alone():
    for seed in range(30):
        text = prose(seed, 120)
        row, out = Q.judge(text)
        if not row["base_failed"]:
            assert row["kept"] and (out == text or row["lines_repeated"])


def test_awkward_rows(edge, nothing):
    out = Q.clean(edge)
    assert [c for c in edge.columns if c != "kept"] == out.columns[:len(edge.columns) - 1]
    want = Counter((r[0], Q.judge(r[1])[0]["n_words"], Q.judge(r[1])[0]["kept"], Q.judge(r[1])[1]) for r in edge_rows())
    assert Counter((r.doc_id, r.n_words, r.kept, r.clean_text) for r in out.collect()) == want
    by_text = {r.doc_id: r for r in out.collect() if r.text in (None, "") and r.doc_id}
    assert by_text[5].clean_text is None and by_text[6].clean_text == "" and not by_text[5].kept
    assert "text" not in Q.score(edge).columns and Q.score(nothing).count() == 0 and Q.clean(nothing).count() == 0
