"""Message streams: decode, route, serve."""
