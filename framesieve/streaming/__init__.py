"""Streaming: frames arriving in a folder, as an extension of the batch scan."""
