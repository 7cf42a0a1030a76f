"""Operators a training-data pipeline needs: filtering, deduplication, tokens, packing, shards."""
