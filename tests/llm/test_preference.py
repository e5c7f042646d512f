from quarry.llm import preference
from quarry.llm.queries import op8_preference

SHAPE = "conv_id long, turn int, role string, text string, kind string"


def rendered(turns):
    text, spans = "", []
    for role, body in turns:
        text += f"<|{role}|>\n"
        if role == "assistant":
            spans.append((len(text), len(body) + len("<|end|>\n")))
        text += body + "<|end|>\n"
    return text, spans


def by_hand(rows):
    turns = {}
    for c, n, role, text in sorted({(c, n, role or "unknown", text or "") for c, n, role, text in rows if c is not None}):
        turns.setdefault(c, []).append((role, text))
    groups, out = {}, {}
    for c, t in turns.items():
        groups.setdefault(t[0], []).append(c)
    said = lambda c: sum(len(x) for role, x in turns[c] if role == "assistant")
    for members in groups.values():
        best = min(members, key=lambda c: (-said(c), c))
        if len(members) == 1:
            t = turns[best]
            spoken = [k for k, (role, _) in enumerate(t) if role == "assistant"]
            n = spoken[-1] if spoken else len(t)
            out[best, None] = ("single", n, rendered(t[:n])[0], *rendered(t[n:]), None, None)
        for r in members:
            if r != best:
                a, b = turns[best], turns[r]
                n = 0
                while n < min(len(a), len(b)) and a[n] == b[n]:
                    n += 1
                out[best, r] = ("same" if a == b else "pair", n, rendered(a[:n])[0], *rendered(a[n:]), *rendered(b[n:]))
    return out


def made(frame):
    spans = lambda m: m and [(x.start, x.length) for x in m]
    return {(r.chosen_id, r.rejected_id): (r.kind, r.n_prompt_turns, r.prompt, r.chosen, spans(r.chosen_mask) or [], r.rejected,
                                           None if r.rejected_mask is None else spans(r.rejected_mask) or [])
            for r in preference.preference_examples(frame).collect()}


def test_pairs_prompts_and_masks(spark):
    rows = []
    for c in range(40):
        rows += [(c, 0, "user", f"question {c % 6}"), (c, 1, "assistant", "answer " * (c % 4)), (c, 2, "user", "more"),
                 (c, 3, "assistant", f"é漢 end {c % 3}")][: 2 + c % 3]
    rows += [(50, 0, "user", "alone"), (51, 0, None, None), (51, 1, "assistant", "x"), (52, 0, "system", "s"), (52, 1, "user", "u"),
             (52, 2, "assistant", "a"), (52, 3, "user", "last"), (None, 0, "user", "lost"), (53, 5, "user", "question 0"), (53, 5, "user", "question 0")]
    rows += [(60, 0, "user", "long")] + [(60, n, "assistant", "t" * 200) for n in range(1, 300)]
    frame = spark.createDataFrame([(*r, "k") for r in rows], SHAPE)
    assert made(frame) == by_hand(rows)
    assert made(frame.limit(0)) == {}


def test_whole_table(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = by_hand(rows)
    got = {(r.chosen_id, r.rejected_id): (r.kind, r.n_prompt_turns, r.prompt, r.chosen, r.rejected) for r in op8_preference(spark, sf_small).collect()}
    assert got == {k: (v[0], v[1], v[2], v[3], v[5]) for k, v in want.items()}
