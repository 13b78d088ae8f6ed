import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from cairn.llm import token_counts as x

TEXTS = ["", " ", "  a", "a  b ", "▁x▁ y", "日本語 テキスト <s> <0x0A> ünï\n\n\tx", "aaaa aaaaaaaa", "word " * 20_000, "q" * 3000, "\u0000 🙂🙂"]


def exact(pieces, unk, fallback):
    t = Tokenizer(models.Unigram(pieces, unk, byte_fallback=fallback))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement=x.MARK, prepend_scheme="always", split=True)
    return t


@pytest.mark.parametrize("fallback", [True, False])
def test_counts_match_the_library(fallback, prose):
    pieces = x.read_pieces(x.VOCABULARY)
    tool, library = x.Counter(pieces, fallback), exact(pieces, 0, fallback)
    for t in [*TEXTS, prose(1, 2000)]:
        assert tool.of_text(t)[0] == len(library.encode(t, add_special_tokens=False).ids), t[:40]


def test_ties_go_to_the_earlier_start():
    pieces = [("<unk>", 0.0), (x.MARK, -1.0), ("a", -1.0), ("b", -1.0), ("c", -1.0), ("ab", -2.0), ("bc", -2.0), ("abc", -3.0), ("aa", -2.0), ("aaa", -3.0), (x.MARK + "a", -2.0)]
    tool, library = x.Counter(pieces, False), exact(pieces, 0, False)
    for t in ["abc", "aabc", "aaa", "aaaa", "zabc", "abzzc", "a b", "cab aaab"]:
        assert tool.of_text(t)[0] == len(library.encode(t, add_special_tokens=False).ids), t


def test_rows(docs):
    rows = [(1, None), (2, ""), (3, "same words"), (3, "same words"), (None, "x")]
    got = sorted(((r["doc_id"] is None, r["doc_id"], r["n_tokens"] > 0) for r in x.count_tokens(docs(rows)).collect()), key=str)
    assert got == sorted([(False, 1, False), (False, 2, False), (False, 3, True), (False, 3, True), (True, None, True)], key=str)
    assert x.count_tokens(docs([])).collect() == []


def test_forgetting_changes_nothing():
    pieces = x.read_pieces(x.VOCABULARY)
    assert x.Counter(pieces, remembered=1).of_text("a b c a b c") == x.Counter(pieces).of_text("a b c a b c")


def test_long_words_are_not_remembered():
    tool = x.Counter([("▁", -1.0), ("a", -1.0), ("aa", -1.5)])
    long = "a" * 10_000
    assert tool.of_text(long) == tool.of_text(long) == (5001, -1.0 - 7500.0) and long not in tool and not any(len(w) > x.REMEMBERED_CHARS for w in tool)
