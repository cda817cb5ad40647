"""Reading and writing catalogues and the small registries that go with them."""
