"""Table definitions: columns, types, keys, references and the star built from them."""
