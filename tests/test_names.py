"""Names of any number of words against a plain search."""

import random

from corvane.operators import quality


def test_names_of_any_length(spark):
    draw = random.Random(2)
    texts = [" ".join(draw.choice("abc") for _ in range(draw.randint(0, 40))) for _ in range(60)]
    words = [t.split() for t in texts]
    names = {" ".join(w[i:i + n]) for w in words[:8] for n in (1, 2, 3, 4, 5, 6, 7, 9, 11) for i in (0, 3) if len(w) >= i + n}
    names |= {"a b", "a a a a", "c c c c c", "not there at all here", "a b c a"}
    kb = spark.createDataFrame([(n, t) for n in names for t in (["X", "Y"] if n == "a b" else ["X"])] + [("a a a a", "X")], "text_lc string, type string")
    df = spark.createDataFrame([*enumerate(texts), (99, None), (98, "")], "id long, content string")
    got = sorted((r.id, r.pos, r.text_lc, r.label) for r in quality.entity_mentions(df, kb).collect())
    want = sorted(
        (i, at, n, t) for i, w in enumerate(words) for n in names for at in range(len(w))
        if w[at:at + len(n.split())] == n.split() for t in (["X", "Y"] if n == "a b" else ["X"]))
    assert any(len(n.split()) > 4 for _, _, n, _ in want) and got == want
