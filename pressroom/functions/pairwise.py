"""Row-level helpers used inside pandas functions; no Spark objects in here, so they pickle."""


def subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, one word of bits per step over the longer text."""
    if len(a) > len(b):
        a, b = b, a
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & places.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()
