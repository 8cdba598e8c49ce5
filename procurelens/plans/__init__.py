"""Named analytics: model in, result DataFrame out."""
