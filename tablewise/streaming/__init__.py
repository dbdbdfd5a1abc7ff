"""Micro-batch adapter: the batch profile applied to each micro-batch of a stream.

The reference has no streaming operator (no readStream / writeStream, no watermarks or
state); nothing stream-specific is built beyond this scheduling adapter.
"""

from tablewise.streaming.microbatch import profile_batches  # noqa: F401
