"""The smallest test tables. Not in a conftest: subfolders have conftests of their own, which would shadow it."""

SF = "/root/testdata/sf0.001"
