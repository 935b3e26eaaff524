"""Plain Python forms of the word rules."""

import re

TEXT = ("The quick brown fox jumps over the lazy dog while seven wizards mix strange potions in "
        "large copper kettles near the quiet river bank at dawn every single summer morning")
_LOWER = {i: i + 32 for i in range(65, 91)}


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))


def sets_of(text, k=5):
    w = words_of(text)
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
