"""Maximal repeats of a group, the bound of a trie and the tokenizer's memory, against plain versions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from changefeed.llm import patricia, suffix_trees, tokens

WIDTH = 3


def test_nodes_give_the_windows_of_smaller_documents():
    rng = np.random.default_rng(11)
    for letters in (1, 2, 4):
        for _ in range(60):
            runs = []
            for _ in range(int(rng.integers(2, 7))):
                n = int(rng.integers(WIDTH, 9))
                text = b" ".join(b"%d\x01" % i if i % 2 else b"%d" % i for i in rng.integers(0, letters, n))
                runs.append((int(rng.integers(0, 4)), 0, 0, n - WIDTH + 1, text, None))
            words = [r[4].split(b" ") for r in runs]
            places = {(r, k): tuple(words[r][k : k + WIDTH]) for r in range(len(runs)) for k in range(runs[r][3])}
            least = {}
            for (r, _), window in places.items():
                least[window] = min(least.get(window, 9), runs[r][0])
            expected = {at for at, window in places.items() if runs[at[0]][0] > least[window]}
            lost = suffix_trees.subtree(runs, WIDTH)
            assert {(r, k + j) for (r, k), n in lost.items() for j in range(n)} == expected


def test_repeats_are_maximal():
    runs = [(1, 0, 0, 4, b"a b c d e f", None), (2, 0, 0, 4, b"x b c d e y", None)]
    assert list(suffix_trees.maximal_repeats(runs, WIDTH)) == [(4, [(1, 0, 1), (2, 1, 1)])]


def test_bound_counts_nodes():
    trie, most = patricia.Trie("max"), 200_000
    given = []
    for i in range(5_000):
        trie.insert(b"%08d" % (i * 7919 % 5_000), i, 1)
        if trie.bytes > most:
            given += trie.spill()
        assert trie.bytes <= most
    given += trie.drain()
    stack, nodes = [trie.root], 0
    while stack:
        node = stack.pop()
        nodes += 1
        stack.extend((node.children or {}).values())
    assert nodes * patricia.NODE_BYTES <= most
    assert sum(rows for _, _, rows in given) == 5_000


def test_rare_pieces_are_forgotten(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 200)
    monkeypatch.setattr(tokens, "TEXTS", 3)
    rng = np.random.default_rng(5)
    odd = ["<a>", "naïve", "Ünïcode", "東京", "é", "x,", "­", "12-3", "it's"]
    for name, kind in (("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")):
        encode = tokens.Encoder(tokens.public_tokenizers.path(name), kind)
        for _ in range(12):
            texts = [
                " ".join(["the and of", *rng.choice(odd, 4), *(f"w{i}z" for i in rng.integers(0, 5_000, 40))])
                for _ in range(7)
            ]
            ids, edges = encode(pa.array(texts))
            for text, a, b in zip(texts, edges[:-1], edges[1:], strict=True):
                assert ids[a:b].tolist() == encode.whole(text).tolist()
        assert "of" in encode.slot and len(encode.slot) < 700
