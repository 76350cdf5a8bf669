"""Streaming: the reference work is all batch (no watermarks, windows or state), so there is nothing to build here.

The nearest batch semantics are in operators: late trips fall outside their file's months (trips.date_sanity) and periods that
aren't complete are left out (trips.month_cutoff, origins.last_complete_month, panel.trim_incomplete).
"""
