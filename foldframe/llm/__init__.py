"""Operators for preparing language-model training data at corpus scale.

Each module holds one operator with its own interface; `queries` registers
the thin queries over the driver tables. Nothing outside this folder
imports it."""
