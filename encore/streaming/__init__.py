"""Dashboards on Structured Streaming: sliding-window counts (``windows``),
``foreachBatch`` sinks (``sinks``) and sources / start functions (``jobs``)."""
