"""Cases that whole tables don't hold: long chains of links, very long texts and conversations."""

import hashlib
import random

from foliant.llm import chat, toxicity
from foliant.llm.components import components, joined


def plain_components(links):
    """{node: least node that it reaches}, by union of sets."""
    of = {}
    for a, b in links:
        if a is None or b is None or a == b:
            continue
        x, y = of.setdefault(a, {a}), of.setdefault(b, {b})
        if x is not y:
            x |= y
            for n in y:
                of[n] = x
    return {n: min(s) for n, s in of.items()}


def classes(rows):
    """{node: least node of its class} of (node, root)."""
    rows = [(r.node, r.root) for r in rows.collect()]
    least = {}
    for n, root in rows:
        least[root] = min(n, least.get(root, n))
    assert len({n for n, _ in rows}) == len(rows)
    return {n: least[root] for n, root in rows}


def shapes():
    """A chain in order, one in random order, a star, a circle, repeats, loops and nulls."""
    rnd = random.Random(2)
    mixed = rnd.sample(range(1000, 1200), 200)
    links = [(i, i + 1) for i in range(150)] + list(zip(mixed, mixed[1:], strict=False)) + [(5000, i) for i in range(4900, 5000)]
    links += [(2000 + i, 2000 + (i + 1) % 30) for i in range(30)] + [(7, 7), (8000, 8000), (None, 3), (4, None), (1, 0), (0, 1)]
    rnd.shuffle(links)
    return links


def test_components_against_sets(spark):
    links = shapes()
    df = spark.createDataFrame(links, "a long, b long")
    assert classes(components(df)) == plain_components(links)
    assert components(df.where("false")).count() == 0


def test_components_in_two_steps(spark):
    links = shapes()
    first, second = links[::2], links[1::2]
    frame = lambda x: spark.createDataFrame(x, "a long, b long")
    assert classes(joined(joined(None, frame(first)), frame(second))) == plain_components(links)


def test_toxicity_reads_very_long_texts_whole(spark):
    rnd = random.Random(4)
    calm, harsh = ["garden", "river", "letter", "window", "season"], ["vile", "scum", "wretch", "filth", "loathe"]
    said = lambda words, n: " ".join(rnd.choice(words) for _ in range(n))
    docs = [(i, said(harsh if i % 2 else calm, 30)) for i in range(200)]
    plain = said(calm, 100_000)
    docs += [(1000, plain), (1001, plain + " " + said(harsh, 100_000)), (1002, said(harsh, 100_000)), (1003, "a" * 700_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.op3(spark, df, labels).collect()}
    assert len(got) == len(docs) and all(0 <= s <= 1 for s in got.values())
    assert got[1000] < got[1001] < got[1002] and got[1002] >= 0.7 > got[1000]


def test_chat_of_a_very_long_conversation(spark):
    turns = [(t, "assistant" if t % 2 else "user", f"turn {t} " + "x" * (t % 40)) for t in range(6000)]
    turns[11] = (11, "assistant", "</turn>\\" * 60_000)
    rows = [(1, *r) for r in turns]
    random.Random(1).shuffle(rows)
    got = {r.conv_id: r for r in chat.op10(spark, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    learned = "".join(x for _, role, x in turns if role == "assistant")
    assert got[1].n_turns == 6000 and got[1].loss_chars == len(learned)
    assert got[1].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
    assert got[1].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
