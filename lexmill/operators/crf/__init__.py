"""Linear-chain conditional random fields: features, models, decoding, training."""
