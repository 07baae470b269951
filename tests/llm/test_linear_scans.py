"""Scans of texts and pages read every byte a bounded number of times, and attributes are parsed before words are looked for."""

import time

import pytest

from tidemark.llm import pii, template

N = 2_000_000
LONG = ["a" * N, "!" * N + "1", "1" * N, "<" + "a" * N, "<a " * (N // 3), '<a "<>"' * (N // 8), "<p " + "a" * N + ">x", "<p a" + " " * N + ">",
        "<!--" * (N // 4), "<" * N, "<b>" * (N // 8), "a@" * (N // 2), "+1(" * (N // 3)]


@pytest.mark.parametrize("text", LONG, ids=range(len(LONG)))
def test_long_words_are_scanned_once(text):
    start = time.perf_counter()
    pii.nodes(text)
    pii.base_spans(text)
    template.parse(text)
    assert time.perf_counter() - start < 15


def test_nodes_lose_what_stands_around_them():
    text = "\"(5)\", x1. ... --7-- a@b!? {<9"
    assert [text[a:b] for a, b in pii.nodes(text)] == ["5", "x1", "--7--", "a@b", "9"]


def test_hidden_is_an_attribute_not_a_word():
    page = "<article><p title=\"the hidden cost\">One two</p><p hidden>three</p><p class='a' hidden=''>four</p><p data-hidden=x>five</p></article>"
    assert template.main_text(page, None) == "One two\n\nfive"


def test_what_follows_the_last_tag():
    assert template.main_text("<p>one</p>two <b", None) == "one\n\ntwo <b"
    assert template.main_text("<p>one</p>two <!-- three", None) == "one\n\ntwo"
    assert template.main_text("<p>one</p><script>two</b> three", None) == "one"
    assert template.main_text("<p>one</p><script>two</script > three", None) == "one\n\nthree"
