"""Token ids of whole texts from remembered units, kept per worker across tasks."""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from types import ModuleType

# White space as the pre-tokeniser sees it (Unicode White_Space; Python's \s also has 1C to 1F).
_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: A word with the blank before it, or a run of white space without the blank that goes with the next word.
UNIT = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
#: Longer units are encoded each time and not remembered.
LONGEST_KEPT = 64
#: How a byte-level BPE cuts ASCII text before it merges.
ASCII_CUT = r"'(?:[sdmt]|ll|ve|re)| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"


def byte_ranks(vocabulary: dict[str, int], merges: list) -> dict[bytes, int] | None:
    """Tokens as bytes with their ids, if the merges make them in the order of the ids; else None.

    Where that holds and every token is what its own bytes merge to, "merge the pair whose union has the smallest id"
    and "apply the first merge of the list that fits" take the same steps: two neighbours that make up a token can only
    be the pair its merge names, since up to then nothing has crossed their outer ends.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shown = {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    made = [vocabulary.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in merges]
    if None in made or made != sorted(made):
        return None
    return {bytes(shown[c] for c in token): made_id for token, made_id in vocabulary.items() if all(c in shown for c in token) and (len(token) == 1 or made_id <= made[-1])}


class UnitIds(dict):
    """Ids of texts by a byte-level BPE file of the tokenizers library, as little-endian 32-bit integers.

    Texts are cut into units where the byte-level pre-tokeniser always cuts, so the ids of a text are those of its
    units in order. A unit is encoded when it is first met and remembered. ASCII units, whose character classes are
    beyond doubt, go to tiktoken's merger over the same vocabulary, several times faster on single words; all others
    go to the tokenizer. A text that holds the string of a special token goes to the tokenizer as a whole.
    """

    def __init__(self, path: str, room: int):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; further threads only hold memory
        from tokenizers import Tokenizer

        self.tokenizer, self.room, self.merger = Tokenizer.from_file(path), room, None
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content}
        self.special = sorted(special)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        ranks = byte_ranks({t: i for t, i in model["vocab"].items() if t not in special}, model["merges"])
        if ranks:
            import tiktoken

            self.merger = tiktoken.Encoding("units", pat_str=ASCII_CUT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def __missing__(self, unit: str) -> bytes:
        ids = array("I", self.merger(unit)).tobytes() if self.merger and unit.isascii() else self.whole(unit)
        if len(unit) <= LONGEST_KEPT:
            self[unit] = ids
        return ids

    def make_room(self) -> None:
        if len(self) > self.room:
            self.clear()

    def encode(self, texts: list[str]) -> list[bytes]:
        self.make_room()
        known = self.__getitem__
        return [self.whole(t) if any(s in t for s in self.special) else b"".join(map(known, UNIT.findall(t))) for t in texts]


def unit_ids(path: str, room: int = 1_000_000) -> UnitIds:
    """The :class:`UnitIds` of a file in this worker process; later tasks find what earlier ones remembered.

    This package travels to the workers by value, anew for each task, so its own globals would not last.
    """
    kept = sys.modules.setdefault("_kept_unit_ids", ModuleType("_kept_unit_ids")).__dict__
    if kept.get("path") != path:
        kept.update(path=path, ids=UnitIds(path, room))
    kept["ids"].room = room
    return kept["ids"]
