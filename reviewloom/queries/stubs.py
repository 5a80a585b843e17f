"""Deterministic stand-ins for external models."""

from __future__ import annotations

import hashlib
from threading import local


def _digit(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()[0]


class EchoWriter:
    """Numbers the prompt; refuses prompts whose hash starts with f."""

    def generate(self, prompt, n):
        if _digit(prompt) == "f":
            raise RuntimeError("refused")
        return [f"{i}|{prompt}" for i in range(1, n + 1)]


class FlakyWriter:
    """Needs three tries for hashes that start with 0 to 2 and never answers those that start with f.

    Tries are counted per thread, as long as the prompt stays the same; no earlier prompt is kept.
    """

    def __init__(self):
        self.last = local()

    def generate(self, prompt, n):
        digit = _digit(prompt)
        seen = self.last.tries + 1 if getattr(self.last, "prompt", None) == prompt else 1
        self.last.prompt, self.last.tries = prompt, seen
        if digit == "f" or (digit in "012" and seen < 3):
            raise TimeoutError("busy")
        return [f"plain: {prompt}"] * n


class Labeller:
    """Answers with a label that depends on the prompt, or with none."""

    def generate(self, prompt, n):
        k = int(_digit(prompt), 16) % 5
        if k == 4:
            raise RuntimeError("overloaded")
        return [f"Looking at the review, Label {k} fits." if k < 3 else "I cannot tell."] * n


class LengthScorer:
    """Class by length, probability by length; refuses a batch that holds a text of length 7, 14, ..."""

    def score(self, texts):
        if any(len(t) % 7 == 0 for t in texts):
            raise ValueError("bad text")
        return [("long" if len(t) > 1000 else "short", round(1.0 / (1 + len(t)), 6)) for t in texts]


class VowelEncoder:
    """Counts of the five plain vowels."""

    def encode(self, texts):
        return [[float(t.count(v)) for v in "aeiou"] for t in texts]


class SpaceEncoder:
    """Counts of spaces, commas and full stops."""

    def encode(self, texts):
        return [[float(t.count(c)) for c in " ,."] for t in texts]
