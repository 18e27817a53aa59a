"""What a Python worker still holds when the next operator's task begins."""

import tracemalloc

import public_tokenizers

from shopfloor.llm import bpe_transducer
from shopfloor.llm.remembered import alone

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_other_operators_tasks_drop_the_encoder():
    bpe_transducer.load(PATH).encode("some words")
    assert bpe_transducer.load.cache_info().currsize
    assert list(alone(lambda batches: batches)(iter([1, 2]))) == [1, 2]
    assert not bpe_transducer.load.cache_info().currsize


def test_small_tables_change_no_ids():
    text = "".join(f"piece{i * 7919 % 10007} Übergröße {i}\n" for i in range(3000))
    whole, small = bpe_transducer.load(PATH), bpe_transducer.load(PATH, 1 << 14, 1 << 12)
    assert small.transducer.max_bytes == 1 << 14 and small.ids.limit == 1 << 11
    assert small.encode(text) == whole.encode(text)


def traced(make) -> tuple[int, int]:
    """Bytes that are held after it, and at most while it ran."""
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0]
        kept = make()
        now, peak = tracemalloc.get_traced_memory()
        return now - before, peak - before
    finally:
        tracemalloc.stop()
        del kept


def test_sorts_of_characters_are_found_without_a_string_of_each():
    from shopfloor.llm import pretoken
    assert traced(pretoken.sorts.__wrapped__)[1] < 40 << 20
    sort = pretoken.sorts()
    assert [sort[ord(c)] for c in "a1 .\u00e9\u0663\u2003\U0010ffff"] == [1, 2, 3, 0, 1, 2, 3, 0]


def test_states_take_about_what_is_counted():
    transducer = bpe_transducer.load(PATH).transducer
    words = [f" Übergrößenträger{i * 7919 % 10007}wortbildungsmuster" for i in range(3000)]
    transducer.clear()
    for word in words:  # also makes the ends of tokens, which aren't states
        transducer.encode(word.encode())
    transducer.clear()
    held, _ = traced(lambda: [None for word in words if transducer.encode(word.encode()) is None])
    assert held < 1.1 * transducer.bytes, (held, transducer.bytes)
