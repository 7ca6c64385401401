from basketflow.streaming.ingest import start_ingest
from basketflow.streaming.live_sales import read_live_sales, read_live_top_skus, start_live_sales

__all__ = ["read_live_sales", "read_live_top_skus", "start_ingest", "start_live_sales"]
