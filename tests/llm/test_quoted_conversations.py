"""Quotation linking on the test table's conversations, whose messages are made to quote earlier ones."""

import random
import re
import textwrap
from collections import defaultdict

from topicloom.llm.quotes import linked_conversations


def quoted(text):
    return "\n".join(f">{'' if line.startswith('>') else ' '}{line}" for line in text.split("\n"))


def made_conversations(rows, rng):
    """Messages that answer a drawn earlier one by quoting it: whole, nested, in part, or wrapped anew.

    Every line is told apart by its message's number, so what a message answers is known: (conversation, turn,
    role, text) and (own text, turn answered, depth, turn of the thread's first message).
    """
    messages, truth = [], {}
    for conv, turns in sorted(rows.items()):
        sent, own = {}, {}
        for turn, role, text in sorted(turns):
            lines = [f"{line.strip()} {conv}.{turn}.{k}" for k, line in enumerate((text or "").split("\n")) if line.strip()]
            lines = [line.lstrip(">") for line in lines] or [f"nothing {conv}.{turn}"]
            own[turn] = "\n".join(lines)
            body, answers = own[turn], None
            earlier = [t for t in sent if t < turn]
            if earlier and rng.random() < 0.8:
                answers = rng.choice(earlier)
                kind = rng.choice(["whole", "nested", "part", "wrapped"])
                if kind == "nested":
                    quote = quoted(sent[answers])
                elif kind == "part":
                    line = rng.choice(own[answers].split("\n"))
                    quote = quoted(re.sub("[a-z]", lambda m: m[0].upper(), line))
                elif kind == "wrapped":
                    words = re.sub(r"\s+", " ", own[answers])
                    quote = quoted("\n".join(textwrap.wrap(words, 40, break_long_words=False, break_on_hyphens=False)))
                else:
                    quote = quoted(own[answers])
                body = f"On Monday, someone wrote:\n{quote}\n\n{body}"
            sent[turn] = body
            depth, thread = (truth[conv, answers][2] + 1, truth[conv, answers][3]) if answers is not None else (0, turn)
            truth[conv, turn] = (own[turn], answers, depth, thread)
            messages.append((conv, turn, role, body, "extra"))
    return messages, truth


def test_generated_quotes(spark):
    rows = defaultdict(list)
    for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").collect():
        if r.conv_id is not None and r.turn is not None and r.turn not in {t for t, *_ in rows[r.conv_id]}:
            rows[r.conv_id].append((r.turn, r.role, r.text))
    messages, truth = made_conversations(rows, random.Random(6))
    frame = spark.createDataFrame(messages, "conv_id long, turn long, role string, text string, row string")
    found = linked_conversations(frame).collect()
    assert {(r.conv_id, r.turn): (r.text, r.reply_to, r.depth, r.thread) for r in found} == truth
    assert len(found) == len(messages)
    answers = [r for r in found if r.reply_to is not None]
    assert len(answers) > 100 and max(r.depth for r in found) >= 2
    assert all(r.quoted >= r.linked > 0 for r in answers)
    place = {(r.conv_id, r.turn): r.position for r in found}
    by_conv = defaultdict(list)
    for r in found:
        by_conv[r.conv_id].append(r.position)
        if r.reply_to is not None:
            assert place[r.conv_id, r.reply_to] < r.position
    assert all(sorted(v) == list(range(len(v))) for v in by_conv.values())
