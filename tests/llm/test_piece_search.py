"""The search for pieces: follow-up test without merging pairs, segments cut at marks."""

import random
from itertools import product

from corvane.llm.merges import Merger
from corvane.llm.queries import PIECES, vocabulary
from corvane.llm.sentence_pieces import Pieces

WORDS = ["he", "th", "ing", "er", "an", "on", "st", "re", "ou", "é", ".", ",", "!", "中"]


def test_following_tokens_without_merging_each_pair():
    rnd = random.Random(3)
    names = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 5))) for _ in range(60)} | set("abc"))
    ranks = {name: rnd.randint(0, 20) for name in names}
    merger = Merger({name: i for i, name in enumerate(names)}, lambda a, b: ranks.get(a + b))
    for (a, left), (b, right) in product(enumerate(names), repeat=2):
        assert merger.follows(a, b) == (merger.merge([*left, *right]) == [left, right])


def test_merging_is_done_per_token_not_per_pair(monkeypatch):
    import sentencepiece

    own, calls = Pieces(vocabulary(PIECES)), []
    merge = Merger.merge
    monkeypatch.setattr(Merger, "merge", lambda self, *a: calls.append(1) or merge(self, *a))
    library, rnd = sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECES)), random.Random(4)
    texts = [" ".join("".join(rnd.choices(WORDS, k=rnd.randint(1, 14))) for _ in range(50)) for _ in range(60)]
    texts += ["!.!,.?" * 900, "a." * 40, "...", "x!?!"]
    found = [own.encode(t) for t in texts]
    assert found == [library.encode(t) for t in texts]
    assert len(calls) <= len(own.merger._alone) < own.merger.held / 2


def test_common_segments_stay_when_the_memo_is_full(monkeypatch):
    monkeypatch.setattr(Pieces, "LIMIT", 8)
    own, searched = Pieces(vocabulary(PIECES)), []
    search = Pieces._search
    monkeypatch.setattr(Pieces, "_search", lambda self, text, *rest: searched.append(text) or search(self, text, *rest))
    whole = Pieces(vocabulary(PIECES))
    for n in range(200):
        text = f"common word{n} other"
        whole.clear()
        whole.older = {}
        assert own.encode(text) == whole.encode(text)
        assert len(own) <= 8 and len(own.older) <= 8
    assert searched.count(" common") == 201 and searched.count(" other") == 201  # 200 of them by ``whole``
