"""How rows are laid out over tasks: hot keys, bounded lists, product grids."""
