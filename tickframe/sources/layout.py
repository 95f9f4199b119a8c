"""Where the tables of each data kind live."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    """Path templates of one kind of data under a root folder."""

    raw: str
    hive: str
    grid: str

    def path(self, root: str, level: str, peg: str = "", interval: str = "") -> str:
        template = getattr(self, level)
        return f"{root.rstrip('/')}/{template.format(peg=peg, interval=interval)}"


# Folder layouts per kind of data.
LAYOUTS = {
    "spot_trades": Layout(
        "raw/spot/last_trade/peg_symbol={peg}",
        "lossless/spot/last_trade/peg_symbol={peg}",
        "grids/spot/last_trade/{interval}/peg_symbol={peg}",
    ),
    "usd_futures_trades": Layout(
        "raw/trades",
        "lossless/futures/um/last_trade/peg_symbol={peg}",
        "grids/futures/um/last_trade/{interval}/peg_symbol={peg}",
    ),
    "perp_book": Layout("raw/futures/market_data", "lossless/l2", "grids/l2/{interval}"),
    "perp_trades": Layout(
        "raw/futures/trades", "lossless/last_trade", "grids/last_trade/{interval}"
    ),
}
