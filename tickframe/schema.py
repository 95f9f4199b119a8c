"""Fixed input schemas."""

from __future__ import annotations





# Daily trade files. Spot files have no header, futures files have one.
SPOT_TRADES = (
    "trade_id bigint, price double, quantity double, quote_quantity double, time bigint, "
    "is_buyer_maker boolean, is_best_match boolean"
)
FUTURES_TRADES = (
    "id bigint, price double, qty double, quote_qty double, time bigint, is_buyer_maker boolean"
)
FUTURES_RENAMES = {"id": "trade_id", "qty": "quantity", "quote_qty": "quote_quantity"}

# The JSON layouts of two public exchange feeds.
LEVEL_JSON = "struct<px:string,sz:string,n:bigint>"
ENVELOPE_JSON = "channel string, data string"
TRADES_JSON = "array<struct<coin:string,side:string,px:string,sz:string,time:bigint,tid:bigint>>"
BBO_JSON = f"coin string, time bigint, bbo array<{LEVEL_JSON}>"
BOOK_JSON = f"coin string, time bigint, levels array<array<{LEVEL_JSON}>>"
BOOK_ARCHIVE_JSON = (
    "time string, ver_num bigint, "
    f"raw struct<channel:string,data:struct<coin:string,time:bigint,levels:array<array<{LEVEL_JSON}>>>>"
)
PERP_CONTEXT_JSON = (
    "coin string, ctx struct<markPx:string,midPx:string,funding:string,openInterest:string,"
    "dayNtlVlm:string,oraclePx:string>"
)
SPOT_CONTEXT_JSON = (
    "coin string, ctx struct<markPx:string,midPx:string,dayNtlVlm:string,"
    "circulatingSupply:string,totalSupply:string>"
)
MIDS_JSON = "mids map<string,string>"
PERP_META_JSON = (
    "universe array<struct<name:string,szDecimals:int,maxLeverage:int,isDelisted:boolean,"
    "onlyIsolated:boolean>>"
)
SPOT_META_JSON = (
    "universe array<struct<name:string,tokens:array<bigint>,index:bigint,isCanonical:boolean>>, "
    "tokens array<struct<name:string,index:bigint>>"
)
# Trade: symbol, event time, trade id, price, quantity, buyer and seller order, trade time,
# buyer is maker. Ticker: update id, symbol, bid price and size, ask price and size. Level
# changes: symbol, event time, first and final update id, bids, asks.
SHORT_TRADE_KEYS = "s E t p q b a T m"
SHORT_TICKER_KEYS = "u s b B a A"
SHORT_DIFF_KEYS = "s E U u b a"
SHORT_DEPTH_JSON = "lastUpdateId bigint, bids array<array<string>>, asks array<array<string>>"
