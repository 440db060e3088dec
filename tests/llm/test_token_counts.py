import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from weatherloom.llm.token_counts import _loaded, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library_count(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(), max_size=5))
def test_counts_equal_the_library(texts):
    texts = [*texts, "x<|endoftext|> <|endoftext|>y", "aaaaaaaaaaaaa", "abab" * 30, "  a \n\n b's  "]
    assert _loaded(PATH).count(texts) == [library_count(t) for t in texts]


def test_rows(odd, documents, empty):
    for frame in (odd, documents):
        got = count_tokens(frame, PATH).collect()
        want = [(r.doc_id, len((r.text or "").encode()), library_count(r.text)) for r in frame.collect()]
        assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=str) == sorted(want, key=str)
        assert all(r.over_limit == (r.n_tokens > 512) for r in got)
    assert count_tokens(empty, PATH).count() == 0
