"""Reading and writing of the raw inputs and of the layers built from them."""
