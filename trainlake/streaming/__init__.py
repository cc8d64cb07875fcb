from trainlake.streaming.refine import (
    AVAILABLE_NOW,
    quarantine_stream,
    refine_all,
    refine_stream,
    wait_for_all,
)

__all__ = ["AVAILABLE_NOW", "quarantine_stream", "refine_all", "refine_stream", "wait_for_all"]
