"""Reading ticks, bars, universes and landed provider rows, and writing them back."""
