"""Streaming counterparts: request summaries, the rate limiter, budgets and cache filling."""
