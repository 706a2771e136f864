"""Small labelled texts for model tests: stiff letters (1) and chatty notes (0)."""

from __future__ import annotations

THINGS = ("the harbour", "our garden", "a bicycle", "the old mill", "this kitchen", "a lantern")
WHEN = ("before noon", "after the rain", "late in autumn", "on quiet days", "at first light")


def letter(i: int) -> tuple[int, str, int]:
    thing, when = THINGS[i % 6], WHEN[i // 6 % 5]
    if i % 2 == 0:
        text = (
            f"We herewith confirm that {thing} shall be inspected {when}. "
            f"The undersigned requests, moreover, that all remarks on {thing} be submitted in writing. "
            f"Payment number {i} remains due."
        )
    else:
        text = f"hey!! saw {thing} {when} haha... so nice! gonna go there again, wanna come? note {i}!"
    return i, text, 1 - i % 2


def letters(spark, n: int):
    return spark.createDataFrame([letter(i) for i in range(n)], "doc_id bigint, text string, label int")
