"""The stages of the whole flow, from landing files to an evaluated model."""
