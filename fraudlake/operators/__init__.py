"""DataFrame -> DataFrame operators of each layer (Bronze, Silver, Gold, gate, log)."""
