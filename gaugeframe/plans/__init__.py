"""Topics: parameters of the whole chain from catalogue to wide table."""
