"""What the text operators need from a SentencePiece model file, and its use chunk by chunk.

The model must normalise by identity, put a marker before the text, keep blanks as they are,
have no user-defined pieces and no piece with a marker after another character. Then a merge
never crosses from a character to a following marker, so a text may be cut there.
"""

from __future__ import annotations

from tickframe.llm.workers import worker_cache


MARK = "▁"


@worker_cache(1)
def processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@worker_cache(1)
def piece_ranks(path: str) -> dict[str, int]:
    """Rank (0 merges first) of every piece that merging may produce."""
    sp = processor(path)
    ids = [
        i for i in range(sp.get_piece_size())
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))
    ]
    best = sorted(ids, key=lambda i: -sp.get_score(i))
    ranks: dict[str, int] = {}
    for r, i in enumerate(best):
        ranks[sp.id_to_piece(i)] = r
    return ranks


def check_model(path: str) -> None:
    sp = processor(path)
    crossing = [p for p in piece_ranks(path) if MARK in p.lstrip(MARK)]
    if crossing:
        raise ValueError(f"pieces cross a marker: {crossing[:3]}")
    for probe, shown in (("a", [MARK + "a"]), ("  a", None)):
        pieces = sp.encode(probe, out_type=str)
        if (shown and pieces != shown) or "".join(pieces) != MARK + probe.replace(" ", MARK):
            raise ValueError("the model does not keep blanks and mark the start")


def marked_texts(texts: list[str]) -> list[str]:
    """Texts as the model sees them, with blanks for markers: one blank before each non-empty."""
    return [" " + (t.replace(MARK, " ") if MARK in t else t) if t else "" for t in texts]
