"""tidewater: real-time commerce analytics expressed as Spark DataFrame plans.

Every operator is a ``DataFrame -> DataFrame`` function that works on batch and
streaming input.  Sources, triggers and sinks live outside the operators;
"today", window sizes and time bounds are parameters.
"""

from tidewater.session import build_session, checkpoint_root, prepare_session

__all__ = ["build_session", "checkpoint_root", "prepare_session"]
