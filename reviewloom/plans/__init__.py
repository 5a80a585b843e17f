"""Shared plan shapes: size-checked broadcasts, exact sampling by hash, distributed ranks."""
