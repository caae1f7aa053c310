from .incremental import merge_bookings_batch, read_quarantine, start_incremental_bookings

__all__ = ["merge_bookings_batch", "read_quarantine", "start_incremental_bookings"]
