from tripmarts.cli import main

main()
