"""Structured Streaming: message sources, bronze sink, trend windows, runner."""
